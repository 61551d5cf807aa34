"""Nearest neighbours against brute force, and their edge cases."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import neighbours
from millrace.llm.catalog import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, cell int, id long, label int"


def every():
    return F.col("vec_id") % 100 == 0


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, None) for i, v in rows], SCHEMA)


def answers(frame):
    found = {}
    for row in frame.collect():
        found.setdefault(row.query_id, []).append((row.rank, row.vec_id, row.score))
    return {query: sorted(rows) for query, rows in found.items()}


def brute(ids, vectors, query, k):
    """The exact answer, in double precision."""
    others = ids != ids[query]
    distance = np.sqrt(((vectors[others] - vectors[query]) ** 2).sum(1))
    order = np.lexsort((ids[others], distance))[:k]
    return list(zip(ids[others][order].tolist(), distance[order].tolist(), strict=True))


def test_recall_and_scores(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids = np.array([row.vec_id for row in rows])
    vectors = np.array([row.embedding for row in rows], np.float64)
    found = answers(QUERIES["op11_neighbours"](spark, SF))
    assert set(found) == {i for i in ids.tolist() if i % 100 == 0}
    hits = 0
    for query, rows in found.items():
        place = int(np.flatnonzero(ids == query)[0])
        exact = brute(ids, vectors, place, 10)
        hits += len({v for _, v, _ in rows} & {v for v, _ in exact})
        assert [rank for rank, _, _ in rows] == list(range(1, 11))
        scores = {v: s for v, s in brute(ids, vectors, place, len(ids))}
        assert all(score == pytest.approx(scores[v], rel=1e-14) for _, v, score in rows)
        assert [r[1:] for r in rows] == sorted((r[1:] for r in rows), key=lambda r: (r[1], r[0]))
    assert hits >= 0.9 * 10 * len(found)


def test_recall_on_larger_groups(spark):
    """2,400 vectors in many partitions, a third of them around one place."""
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(2400, 16))
    vectors[:800] = vectors[0] + 0.01 * rng.normal(size=(800, 16))
    vectors = vectors.astype(np.float32)
    ids = np.arange(2400)
    found = answers(neighbours.nearest(frame(spark, [(int(i), vectors[i].tolist()) for i in ids]), every()))
    exact = vectors.astype(np.float64)
    hits = sum(
        len({v for _, v, _ in rows} & {v for v, _ in brute(ids, exact, query, 10)})
        for query, rows in found.items()
    )
    assert hits >= 0.9 * 240


def test_copies_and_ties(spark):
    """Many copies of the query: the smallest ids win, whichever blocks hold them."""
    rows = [(i, [1.0, 2.0]) for i in range(700)] + [(i, [3.0, 2.0]) for i in range(700, 720)]
    found = answers(neighbours.nearest(frame(spark, rows), every()))
    assert found[0] == [(r, r, 0.0) for r in range(1, 11)]
    assert found[300] == [(r + 1, r, 0.0) for r in range(10)]
    assert found[700][:2] == [(1, 701, 0.0), (2, 702, 0.0)]


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]),
        (5, [None, 1.0]), (6, [1.0]), (7, [2.0, 0.0]), (7, [2.0, 0.0]), (None, [1.0, 0.0]),
        (100, [4.0, 0.0]), (100, [9.0, 0.0]), (200, []), (300, [0.0, 0.0]),
    ]
    found = answers(neighbours.nearest(frame(spark, rows), every()))
    assert found == {
        0: [(1, 7, 1.0), (2, 7, 1.0), (3, 100, 3.0), (4, 100, 8.0)],
        100: [(1, 7, 2.0), (2, 7, 2.0), (3, 0, 3.0)],
    }
    assert neighbours.nearest(frame(spark, []), every()).collect() == []
    assert neighbours.nearest(frame(spark, [(None, None)] * 3), every()).collect() == []
    assert neighbours.nearest(frame(spark, [(1, [1.0]), (2, [2.0])]), every()).collect() == []
    assert neighbours.nearest(frame(spark, [(0, [1.0])]), every()).collect() == []


def test_partitions_are_balanced():
    rng = np.random.default_rng(2)
    rows = rng.normal(size=(1000, 8))
    near = neighbours.nearest_rows(rows, rows, 10, np.arange(1000))
    before = neighbours.halves(rows, 8)
    after = neighbours.cut_graph(near, before, 8)
    assert set(np.bincount(before)) == {125}
    assert np.bincount(after).max() <= np.ceil(neighbours.SLACK * 125)
    inside = [(owner[near] == owner[:, None]).mean() for owner in (before, after)]
    assert inside[1] > inside[0]


def test_slopes_of_the_network():
    """The router learns partitions that can be told apart."""
    rng = np.random.default_rng(6)
    centers = 4 * rng.normal(size=(4, 5))
    owner = rng.integers(0, 4, 800)
    rows = centers[owner] + rng.normal(size=(800, 5))
    router = neighbours.train(rows, np.eye(4, dtype=np.float32)[owner])
    assert (router.partition(rows) == owner).mean() > 0.95
    assert np.allclose(router.chances(rows).sum(1), 1, atol=1e-5)
