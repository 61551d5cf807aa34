"""Nearest neighbours through learned partitions.

The neighbour graph of a bounded sample is cut into balanced partitions: halves along principal
directions first, then vertices move to the partition that holds most of their neighbours while
sizes stay within a bound. A small network learns which partitions hold the neighbours of a
vector. Every row of the table goes to the partition that the network finds likeliest for it, and
a query to its likeliest ones, as many as it takes until their probabilities reach a level. That
level is read off on sample rows that neither the graph's cut nor the network has seen: the one at which
TARGET of their true neighbours are reached. All rows of these partitions are compared with the
query; distances are taken anew on the original vectors before ranking.

The share of rows that a query meets depends on the data: a few percent where they form groups,
half of them or more where 64 directions carry noise alike. Partitions are dealt out in blocks of
rows against blocks of queries, both bounded, so a partition that holds a large part of all rows
is many tasks. Within a block only so many copies of one vector are compared as can be among the
nearest, and of each block only a query's nearest leave it.

Defined results
* rows take part whose id is given and whose vector is given, holds only finite numbers, not only
  zeros, and has the length that most such rows have (the longer one, if equally many);
* ties go to the smaller id; rows with the query's id are its own and never its neighbours;
* a query id that repeats is searched once, with the least of its vectors; a repeated candidate
  counts once for each of its rows;
* fewer candidates than asked for are all returned; no rows give an empty result;
* other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.textops import Batches, prepare, tidy
from millrace.session import scratch

SAMPLE_ROWS = 8192  # rows that the index is learned from
PARTITIONS = 64
ROWS_PER_PARTITION = 64  # of the sample, at least; smaller tables have fewer partitions
HELD_OUT = 8  # one of so many sample rows sets the level
NEIGHBOURS = 16  # edges of a vertex
SLACK = 1.1  # size of a partition against the mean
TARGET = 0.97
HIDDEN, EPOCHS, BATCH, RATE = 128, 8, 256, 0.002
# Rows and queries of a block, at most; blocks of small tables are as large as a partition should be.
BLOCK_ROWS, LEAST_ROWS, BLOCK_QUERIES = 16_384, 512, 2_048
QUERIES_AT_ONCE = 128


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances by the scalar product: quick, and exact to rounding of the lengths."""
    return np.maximum((a**2).sum(1)[:, None] + (b**2).sum(1) - 2 * (a @ b.T), 0)


def nearest_rows(queries: np.ndarray, rows: np.ndarray, k: int, own: np.ndarray | None) -> np.ndarray:
    """The k nearest rows of each query; own: the query's place among the rows, never near."""
    k = min(k, len(rows) - (own is not None))
    found = np.empty((len(queries), k), np.int64)
    for low in range(0, len(queries), 1024):
        near = squared(queries[low : low + 1024], rows)
        if own is not None:
            near[np.arange(len(near)), own[low : low + 1024]] = np.inf
        found[low : low + 1024] = np.argpartition(near, k - 1, 1)[:, :k]
    return found


def halves(rows: np.ndarray, parts: int) -> np.ndarray:
    """Partitions of equal size by repeated cuts across the widest direction."""
    owner = np.zeros(len(rows), np.int64)
    todo = [(np.arange(len(rows)), 0, parts)]
    while todo:
        members, first, count = todo.pop()
        if count == 1:
            owner[members] = first
            continue
        centered = rows[members] - rows[members].mean(0)
        direction = np.linalg.eigh(centered.T @ centered)[1][:, -1]
        order = np.argsort(centered @ direction, kind="stable")
        left = count // 2
        cut = len(members) * left // count
        todo.append((members[order[:cut]], first, left))
        todo.append((members[order[cut:]], first + left, count - left))
    return owner


def cut_graph(neighbours: np.ndarray, owner: np.ndarray, parts: int, rounds: int = 15) -> np.ndarray:
    """Move vertices to the partition of most of their neighbours, within the bound on sizes."""
    n, degree = neighbours.shape
    ends = np.repeat(np.arange(n), degree), neighbours.ravel()
    a, b = np.concatenate(ends), np.concatenate(ends[::-1])
    most, owner = int(np.ceil(SLACK * n / parts)), owner.copy()
    sizes = np.bincount(owner, minlength=parts)
    rng = np.random.default_rng(5)
    for _ in range(rounds):
        edges = np.bincount(a * parts + owner[b], minlength=n * parts).reshape(n, parts)
        gain = edges - edges[np.arange(n), owner][:, None]
        gain[np.arange(n), owner] = -1
        to = gain.argmax(1)
        best = gain[np.arange(n), to]
        # Half of them at a time, or neighbours would swap places for ever.
        movers = np.flatnonzero((best > 0) & (rng.random(n) < 0.5))
        moved = 0
        for i in movers[np.argsort(-best[movers], kind="stable")]:
            if sizes[to[i]] < most:
                sizes[owner[i]] -= 1
                sizes[to[i]] += 1
                owner[i] = to[i]
                moved += 1
        if moved < n / 500:
            break
    return owner


def probabilities(scores: np.ndarray) -> np.ndarray:
    powers = np.exp(scores - scores.max(1, keepdims=True))
    return powers / powers.sum(1, keepdims=True)


@dataclass
class Router:
    """A network of one hidden layer from a vector to partitions, and the level to reach."""

    center: np.ndarray
    scale: float
    weights: list[np.ndarray]
    level: float = 1.0

    def chances(self, vectors: np.ndarray) -> np.ndarray:
        into, shift, out, bias = self.weights
        scaled = ((vectors - self.center) * self.scale).astype(np.float32)
        return probabilities(np.maximum(scaled @ into + shift, 0) @ out + bias)

    def partition(self, vectors: np.ndarray) -> np.ndarray:
        """Where rows belong."""
        return self.chances(vectors).argmax(1)

    def before(self, vectors: np.ndarray) -> np.ndarray:
        """For each partition the probability of those that are likelier."""
        chances = self.chances(vectors)
        order = np.argsort(-chances, 1, kind="stable")
        ordered = np.take_along_axis(chances, order, 1).astype(np.float64)
        total = np.empty_like(ordered)
        np.put_along_axis(total, order, np.cumsum(ordered, 1) - ordered, 1)
        return total

    def probes(self, vectors: np.ndarray) -> np.ndarray:
        """Which partitions a query goes to: rows of true and false."""
        return self.before(vectors) <= self.level


def train(vectors: np.ndarray, wanted: np.ndarray, seed: int = 3) -> Router:
    """A network whose probabilities are the shares of neighbours, by stochastic gradients."""
    rng = np.random.default_rng(seed)
    center = vectors.mean(0)
    scale = 1 / max(float(np.sqrt(((vectors - center) ** 2).mean())), 1e-12)
    scaled = ((vectors - center) * scale).astype(np.float32)
    size, parts = vectors.shape[1], wanted.shape[1]
    into = rng.normal(0, np.sqrt(2 / size), (size, HIDDEN)).astype(np.float32)
    out = rng.normal(0, 0.1 / np.sqrt(HIDDEN), (HIDDEN, parts)).astype(np.float32)
    weights = [into, np.zeros(HIDDEN, np.float32), out, np.zeros(parts, np.float32)]
    mean = [np.zeros_like(w) for w in weights]
    square = [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(scaled))
        for low in range(0, len(order), BATCH):
            rows = order[low : low + BATCH]
            hidden = np.maximum(scaled[rows] @ weights[0] + weights[1], 0)
            error = probabilities(hidden @ weights[2] + weights[3]) - wanted[rows]
            error /= len(rows)
            back = (error @ weights[2].T) * (hidden > 0)
            slopes = scaled[rows].T @ back, back.sum(0), hidden.T @ error, error.sum(0)
            step += 1
            for w, slope, m, s in zip(weights, slopes, mean, square, strict=True):
                m += 0.1 * (slope - m)
                s += 0.001 * (slope * slope - s)
                rate = RATE * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                w -= rate * m / (np.sqrt(s) + 1e-8)
    return Router(center, scale, weights)


def learn(sample: np.ndarray, k: int) -> Router:
    """Partitions of a sample, the network, and the level that reaches TARGET of k neighbours."""
    held = np.arange(len(sample)) % HELD_OUT == HELD_OUT - 1
    used = sample[~held]
    parts = max(1, min(PARTITIONS, len(used) // ROWS_PER_PARTITION))
    if parts == 1 or not held.any():
        width = sample.shape[1]
        return Router(np.zeros(width), 1.0, [np.zeros((width, 1), np.float32), *(
            np.zeros(shape, np.float32) for shape in ((1,), (1, 1), (1,))
        )])
    neighbours = nearest_rows(used, used, NEIGHBOURS, np.arange(len(used)))
    owner = cut_graph(neighbours, halves(used, parts), parts)
    wanted = np.zeros((len(used), parts), np.float32)
    near = np.c_[np.arange(len(used)), neighbours]
    np.add.at(wanted, (np.repeat(np.arange(len(used)), near.shape[1]), owner[near.ravel()]), 1)
    router = train(used, wanted / near.shape[1])
    # Sample rows are sparser than the table, so their neighbours are farther off: on the safe side.
    true = nearest_rows(sample[held], sample, k, np.flatnonzero(held))
    at = router.partition(sample)[true]
    reached = np.take_along_axis(router.before(sample[held]), at, 1)
    router.level = float(np.quantile(reached, TARGET))
    return router


def vectors_of(column: pa.Array) -> np.ndarray:
    """Vectors of one length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _assign(router: Router) -> Callable[[Batches], Batches]:
    def assign(batches: Batches) -> Batches:
        for batch in batches:
            cells = router.partition(vectors_of(batch.column(1))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells)], names=["id", "vector", "cell"]
            )

    return assign


def _route(router: Router) -> Callable[[Batches], Batches]:
    def route(batches: Batches) -> Batches:
        for batch in batches:
            probes = router.probes(vectors_of(batch.column(1)))
            ends = np.r_[0, np.cumsum(probes.sum(1))].astype(np.int32)
            cells = pa.array(np.nonzero(probes)[1].astype(np.int32))
            lists = pa.ListArray.from_arrays(pa.array(ends), cells)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, lists], names=["id", "vector", "cells"]
            )

    return route


def fewer_copies(ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the rows without those copies of a vector that no query can need.

    Copies are equally near, so only the k + 1 smallest ids of them can count, one of which may
    be the query itself.
    """
    whole = np.ascontiguousarray(rows).view(np.dtype((np.void, rows.shape[1] * 8))).ravel()
    names = np.unique(whole, return_inverse=True)[1].ravel()
    order = np.lexsort((ids, names))
    first = np.flatnonzero(np.r_[True, np.diff(names[order]) != 0])
    rank = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
    return order[rank <= k]


def nearest_in_block(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query id, row id and distance of the k nearest rows of a block for each query."""
    kept = fewer_copies(ids, rows, k)
    ids, rows = ids[kept], rows[kept]
    found = []
    for low in range(0, len(queries), QUERIES_AT_ONCE):
        own_ids, part = query_ids[low : low + QUERIES_AT_ONCE], queries[low : low + QUERIES_AT_ONCE]
        near = squared(part, rows)
        near[own_ids[:, None] == ids] = np.inf
        last = np.partition(near, min(k, len(rows)) - 1, 1)[:, min(k, len(rows)) - 1]
        # The quick distances are off by rounding; what lies so near the last counts as well.
        error = 1e-13 * rows.shape[1] * ((part**2).sum(1) + (rows**2).sum(1).max())
        for i in range(len(part)):
            some = np.flatnonzero((near[i] <= last[i] + error[i]) & np.isfinite(near[i]))
            exact = np.sqrt(((rows[some] - part[i]) ** 2).sum(1))
            best = np.lexsort((ids[some], exact))[:k]
            found.append((np.full(len(best), own_ids[i]), ids[some[best]], exact[best]))
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def _compare(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def compare(rows: pa.Table, queries: pa.Table) -> pa.Table:
        if len(rows) and len(queries):
            columns = nearest_in_block(
                queries["id"].to_numpy(),
                vectors_of(queries["vector"].combine_chunks()),
                rows["id"].to_numpy(),
                vectors_of(rows["vector"].combine_chunks()),
                k,
            )
        else:
            columns = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        return pa.table(list(columns), names=["query_id", "vec_id", "score"])

    return compare


def usable(vectors: DataFrame, is_query: Column, id_name: str, vector_name: str) -> DataFrame:
    """Rows id, vector, asked (whether it is a query) that take part."""
    vector = F.col(vector_name)
    infinite = F.lit(float("inf"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    other = F.exists(vector, lambda x: x != 0)
    rows = vectors.where(F.col(id_name).isNotNull() & vector.isNotNull() & finite & other)
    rows = rows.select(
        F.col(id_name).cast("long").alias("id"), vector.alias("vector"), is_query.alias("asked")
    )
    sizes = rows.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("rows"))
    most = sizes.orderBy(F.desc("rows"), F.desc("size")).first()
    return rows.where(F.size("vector") == (most["size"] if most else 0))


def sampled(rows: DataFrame, count: int) -> np.ndarray:
    """About SAMPLE_ROWS vectors (all, if there are no more), in an order by hash.

    Rows that share an id share their draw, so the number of rows is bounded besides.
    """
    draw = F.pmod(F.xxhash64("id"), F.lit(1 << 40))
    share = min(1.0, SAMPLE_ROWS / max(count, 1))
    some = rows.where(draw < int(share * (1 << 40))) if share < 1 else rows
    found = some.select("id", draw.alias("draw"), "vector").limit(2 * SAMPLE_ROWS).toArrow()
    order = np.lexsort((found["id"].to_numpy(), found["draw"].to_numpy()))
    return vectors_of(found["vector"].combine_chunks())[order]


def _blocks(counts: dict[int, int], size: int) -> Column:
    """The number of blocks of a cell, by the rows it has."""
    pairs = [F.lit(x) for cell, n in sorted(counts.items()) for x in (cell, -(-n // size))]
    return F.create_map(*pairs)[F.col("cell")]


def _counted(rows: DataFrame) -> dict[int, int]:
    """Rows per cell, of which there are PARTITIONS at most."""
    return {row["cell"]: row["n"] for row in rows.groupBy("cell").agg(F.count("*").alias("n")).collect()}


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_name: str = "vec_id",
    vector_name: str = "embedding",
) -> DataFrame:
    """The nearest rows found for each query: query_id, rank, vec_id, score (the distance)."""
    spark = vectors.sparkSession
    prepare(spark)
    empty = "query_id long, rank int, vec_id long, score double"
    rows = usable(vectors, is_query, id_name, vector_name)
    count = rows.count()
    if not count:
        return spark.createDataFrame([], empty)
    router = learn(sampled(rows, count), k)
    kind = rows.schema["vector"].dataType.simpleString()
    path = scratch(spark, "neighbour-cells")
    assigned = rows.drop("asked").mapInArrow(tidy(_assign(router)), f"id long, vector {kind}, cell int")
    assigned.write.parquet(path)
    index = spark.read.parquet(path)

    chosen = rows.where("asked").groupBy("id").agg(F.min("vector").alias("vector"))
    path = scratch(spark, "neighbour-probes")
    routed = chosen.mapInArrow(tidy(_route(router)), f"id long, vector {kind}, cells array<int>")
    routed.write.parquet(path)
    probes = spark.read.parquet(path).select("id", "vector", F.explode("cells").alias("cell"))

    sizes, asked = _counted(index), _counted(probes.select("cell"))
    if not asked:
        return spark.createDataFrame([], empty)
    block = min(BLOCK_ROWS, max(LEAST_ROWS, count // PARTITIONS))
    row_blocks, query_blocks = _blocks(sizes, block), _blocks(asked, BLOCK_QUERIES)
    own = F.pmod(F.xxhash64("id"), F.lit(1 << 40))

    def every(blocks: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), blocks.cast("long") - 1))

    # Every block of a partition's rows meets every block of its queries.
    tile = ("cell", "row_block", "query_block")
    left = index.withColumn("row_block", own % row_blocks).withColumn("query_block", every(query_blocks))
    right = probes.withColumn("query_block", own % query_blocks).withColumn("row_block", every(row_blocks))
    found = (
        left.groupBy(*tile)
        .cogroup(right.groupBy(*tile))
        .applyInArrow(_compare(k), "query_id long, vec_id long, score double")
    )
    ranked = found.withColumn(
        "rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    )
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
