"""Near duplicates by circulant MinHash.

Shingles fall into a universe of 2**20 places. One permutation scatters the places, a second one
gives each place its value, and coordinate k of a signature is the least value after shifting the
second permutation circularly by k: two permutations give all coordinates, and those of one
shingle are neighbours in memory. Bands of the signature name buckets; rows that share a bucket
are candidates, and every link is confirmed on the full shingle sets.

How groups are kept small, without losing links:
* rows with equal sequences of words (by 128 bits of BLAKE2) are one class from the start, so
  copies never pair;
* in a first round every class is paired with one center of its buckets, in two more with a few
  centers of random parts of them;
* of what these links do not already join, the classes that share a bucket with another component
  are compared across components by the prefixes of their sets (see prefixes.py). That is exact:
  no pair that is similar enough is left out, whatever the sizes of groups, and texts that differ
  too much from all others, or only hold a common passage, are never paired.

Defined results
* text is lower-cased in A-Z only; words are runs of anything but space and \\t to \\r;
* with fewer words than a shingle has, the whole sequence is the one shingle; without words or
  text the set is empty and linked with nothing;
* component_id is the smallest doc_id reachable; null ids never are, unless all are null;
* repeated rows (same id, same text) share one verdict; an empty table gives an empty result;
* other columns, whatever their names, are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.prefixes import candidate_pairs
from millrace.llm.textops import (
    LOWER,
    LOWER_BYTES,
    as_bytes,
    blocks,
    mix,
    prepare,
    span_hashes,
    tidy,
    word_spans,
)
from millrace.session import scratch

UNIVERSE_BITS = 20
# Rounds of pairs with centers, before what is left is paired. After the first, large buckets are
# dealt into groups of GROUP classes, and a class is paired with CENTERS of its groups' centers.
TURNS = 3
GROUP = 16
CENTERS = 3
# Shingles whose coordinates are computed at once.
SHINGLES_AT_ONCE = 256


@dataclass(frozen=True)
class NearRule:
    """Words of a shingle, similarity in percent, and the shape of the signature."""

    words: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 5
    seed: int = 20240

    @property
    def size(self) -> int:
        """Coordinates of a signature."""
        return self.bands * self.rows


@functools.lru_cache(maxsize=2)
def permutations(seed: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The scattering permutation, and windows of the shifted one: row i holds all shifts of i."""
    rng = np.random.default_rng(seed)
    scatter = rng.permutation(1 << UNIVERSE_BITS).astype(np.int32)
    values = rng.permutation(1 << UNIVERSE_BITS).astype(np.int32)
    circle = np.concatenate([values, values[: size - 1]])
    return scatter, np.lib.stride_tricks.sliding_window_view(circle, size)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of one text's word hashes."""
    if not len(words):
        return words
    size = min(size, len(words))
    total = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        total = mix(total + words[k : len(words) - size + 1 + k])
    return np.unique(total)


def signature(shingles: np.ndarray, rule: NearRule) -> np.ndarray:
    scatter, windows = permutations(rule.seed, rule.size)
    places = scatter[(shingles & np.uint64((1 << UNIVERSE_BITS) - 1)).astype(np.int64)]
    least = np.full(rule.size, np.iinfo(np.int32).max, np.int32)
    for low in range(0, len(places), SHINGLES_AT_ONCE):
        np.minimum(least, windows[places[low : low + SHINGLES_AT_ONCE]].min(0), out=least)
    return least


def band_keys(least: np.ndarray, rule: NearRule) -> np.ndarray:
    keys = mix(np.arange(rule.bands, dtype=np.uint64) + np.uint64(rule.seed))
    for column in least.reshape(rule.bands, rule.rows).T:
        keys = mix(keys + column.astype(np.uint64))
    return keys.view(np.int64)


SIGNED = "doc_id long, text_hash long, set binary, n long, keys array<long>"


def shingled(texts: pa.Array, words: int) -> Iterator[tuple[bytes, np.ndarray]]:
    """For each text its bytes in lower case, and the sorted distinct hashes of its shingles."""
    data, offsets = as_bytes(texts)
    for low, high in blocks(offsets):
        part = LOWER[data[offsets[low] : offsets[high]]]
        places = offsets[low : high + 1] - offsets[low]
        starts, ends, first = word_spans(part, places)
        hashes = span_hashes(part, starts, ends)
        for i in range(high - low):
            text = part[places[i] : places[i + 1]].tobytes()
            yield text, shingle_hashes(hashes[first[i] : first[i + 1]], words)


def _sign(rule: NearRule):
    def one(text: bytes, shingles: np.ndarray) -> tuple:
        if not len(shingles):
            return b"", 0, []
        name = hashlib.blake2b(b" ".join(text.split()), digest_size=16).digest()
        return name, len(shingles), band_keys(signature(shingles, rule), rule)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [one(*found) for found in shingled(batch.column(2), rule.words)]
            names, counts, keys = list(zip(*rows, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(names, pa.binary()),
                    pa.array(counts, pa.int64()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_hash", "set", "n", "keys"],
            )

    return sign


def _members(rule: NearRule):
    """Ids and components of classes with the shingles of their texts."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [found.view(np.int64) for _, found in shingled(batch.column(2), rule.words)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(found) for found in sets], pa.int64()),
                    pa.array(sets, pa.list_(pa.int64())),
                ],
                names=["id", "component", "n", "members"],
            )

    return members


def shingle_set(text: str, size: int) -> set[tuple[bytes, ...]]:
    """The exact set of a text: tuples of words."""
    words = text.encode().translate(LOWER_BYTES).split()
    size = min(size, len(words))
    return set(zip(*(words[k:] for k in range(size)), strict=False)) if size else set()


def _confirm(rule: NearRule):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, other = None, set()
        for batch in batches:
            a, b, texts_a, texts_b = (column.to_pylist() for column in batch.columns)
            linked = []
            for i in range(len(a)):
                if a[i] != last:  # pairs of one row follow each other
                    last, other = a[i], shingle_set(texts_a[i], rule.words)
                own = shingle_set(texts_b[i], rule.words)
                shared = len(own & other)
                union = len(own) + len(other) - shared
                if shared and 100 * shared >= rule.percent * union:
                    linked.append(i)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(linked, pa.int64())),
                 batch.column(1).take(pa.array(linked, pa.int64()))],
                names=["a", "b"],
            )

    return confirm


def _kept(rows: DataFrame, name: str) -> DataFrame:
    path = scratch(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _links(pairs: DataFrame, texts: DataFrame, rule: NearRule) -> DataFrame:
    """The pairs (a, b) of classes whose full sets are similar enough."""
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    left = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    full = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
    return _kept(full.mapInArrow(tidy(_confirm(rule)), "a long, b long"), "links")


def _labelled(buckets: DataFrame, member: DataFrame | None) -> DataFrame:
    """Rows of the buckets with the component that each class belongs to so far."""
    if member is None:
        return buckets.withColumn("component", F.col("id"))
    named = member.withColumnRenamed("node", "id")
    joined = buckets.join(named, "id", "left")
    return joined.withColumn("component", F.coalesce("component", "id"))


def _stars(labelled: DataFrame, turn: int) -> DataFrame:
    """Pairs with centers, for classes that share a bucket with another component.

    A group's center is its member that shares buckets with most others (the text that copies
    were made from, or one near it). In the first turn a bucket is one group, and a class takes
    the first of its centers. That may be a text that lies a little aside and leaves many links
    open, so later turns deal large buckets into groups of some GROUP classes by chance, which
    have centers of their own, and a class takes the CENTERS that it shares most groups with.
    """
    key, group = ["key"], labelled
    if turn:
        # Powers of two, so that two classes which meet in a large bucket do in smaller ones too.
        parts = F.expr(f"shiftleft(1L, CAST(ceil(log2(greatest(size / {GROUP}, 1))) AS INT))")
        group = labelled.withColumn("part", F.pmod(F.xxhash64("id", F.lit(turn)), parts))
        key = ["key", "part"]
    center = F.struct((-F.col("weight")).alias("priority"), "id", "component")
    centers = group.groupBy(*key).agg(
        F.min(center).alias("center"), F.min("component").alias("x"), F.max("component").alias("y")
    )
    open_rows = group.join(centers.where("x < y").select(*key, "center"), key)
    open_rows = open_rows.where("component <> center.component")
    if not turn:
        taken = open_rows.groupBy("id").agg(F.min("center").alias("center"))
    else:
        met = open_rows.groupBy("id", "center").agg(F.count(F.lit(1)).alias("met"))
        best = Window.partitionBy("id").orderBy(F.desc("met"), "center")
        taken = met.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= CENTERS)
    return taken.select(F.least("id", "center.id").alias("a"), F.greatest("id", "center.id").alias("b"))


def _across(labelled: DataFrame, texts: DataFrame, rule: NearRule) -> DataFrame:
    """Pairs across components, of classes that share a bucket with another component."""
    mixed = labelled.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    rows = labelled.join(mixed.where("x < y").select("key"), "key", "left_semi")
    rows = _kept(rows.select("id", "component").distinct(), "open")
    held = rows.join(texts, "id").select("id", "component", "text")
    kinds = "id long, component long, n long, members array<long>"
    sets = _kept(held.mapInArrow(tidy(_members(rule)), kinds), "sets")
    return candidate_pairs(sets, rule.percent, _kept)


def signed(documents: DataFrame, rule: NearRule) -> tuple[DataFrame, DataFrame]:
    """Texts with a hash of each, and a written table of their sets and band keys."""
    prepare(documents.sparkSession)
    text = F.coalesce(F.col("text"), F.lit(""))
    texts = documents.select(
        F.col("doc_id").cast("long"), F.xxhash64(text).alias("text_hash"), text.alias("text")
    )
    return texts, _kept(texts.mapInArrow(tidy(_sign(rule)), SIGNED), "signatures")


def near_duplicates(documents: DataFrame, rule: NearRule = NearRule()) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, text_hash, first_hash.

    first_hash is the text_hash of the row that stays, which tells rows of one id apart.
    """
    texts, rows = signed(documents, rule)
    place = F.struct("doc_id", "text_hash")
    classes = rows.where("n > 0").groupBy("set").agg(
        F.min("doc_id").alias("least"),
        F.min(F.when(F.col("doc_id").isNotNull(), place)).alias("first"),
        F.min(place).alias("row"),
        F.any_value("n").alias("n"),
        F.any_value("keys").alias("keys"),
    )
    classes = _kept(classes.withColumn("id", F.monotonically_increasing_id()), "classes")

    # Buckets with two classes or more, and the texts of their classes.
    bands = classes.select("id", F.posexplode("keys").alias("band", "key"))
    shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    sized = _kept(bands.join(shared, "key"), "buckets")
    weight = sized.groupBy("id").agg(F.sum("size").alias("weight"))
    buckets = _kept(sized.join(weight, "id"), "buckets")
    needed = buckets.select("id").distinct().join(classes, "id").select("id", "row.*")
    same = texts["doc_id"].eqNullSafe(needed["doc_id"]) & (texts["text_hash"] == needed["text_hash"])
    held = texts.join(needed, same).select("id", "text")
    held = _kept(held.groupBy("id").agg(F.any_value("text").alias("text")), "texts")

    links, seen, member = None, None, None
    for turn in range(TURNS + 1):
        labelled = _labelled(buckets, member)
        if turn < TURNS:
            pairs = _stars(labelled, turn).distinct()
        else:
            pairs = _across(labelled, held, rule)
        if seen is not None:
            pairs = pairs.join(seen, ["a", "b"], "left_anti")
        pairs = _kept(pairs, "pairs")
        found = _links(pairs, held, rule)
        seen = pairs if seen is None else seen.unionAll(pairs)
        links = found if links is None else links.unionAll(found)
        if member is None or not found.isEmpty():
            member = components(links)

    named = classes.join(member.withColumnRenamed("node", "id"), "id", "left").select(
        "set", "least", "first", F.coalesce("component", "id").alias("component")
    )
    smallest = named.groupBy("component").agg(
        F.min("least").alias("component_id"), F.min("first").alias("first")
    )
    named = named.select("set", "component").join(smallest, "component").drop("component")
    joined = rows.select("doc_id", "text_hash", "set", "n").join(named, "set", "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    first = F.when(F.col("n") == 0, F.col("text_hash")).otherwise(
        F.coalesce("first.text_hash", "text_hash")
    )
    return joined.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        "text_hash",
        first.alias("first_hash"),
    )


def _place(doc_id: Column, text_hash: Column) -> list[Column]:
    """Columns that are equal where ids, nulls included, and hashes are."""
    return [
        F.coalesce(doc_id, F.lit(0).cast("long")).alias("own_id"),
        doc_id.isNull().alias("no_id"),
        text_hash.alias("own_hash"),
    ]


def drop_near_duplicates(documents: DataFrame, rule: NearRule = NearRule()) -> DataFrame:
    """The documents without near duplicates: of each component the row that stays.

    A row stays if it has the smallest id of its component and the text of the first row with
    that id; rows that repeat it in id and text go.
    """
    found = near_duplicates(documents, rule)
    stay = found.where(F.col("kept") & (F.col("text_hash") == F.col("first_hash")))
    # Whole rows in one column, so that no name of theirs can clash. Keys without nulls let the
    # rows, which are long, move once for the join and for its repeats.
    held = documents.select(
        F.struct("*").alias("row"),
        *_place(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce(F.col("text"), F.lit("")))),
    )
    stay = stay.select(*_place(F.col("doc_id"), F.col("text_hash"))).distinct()
    place = ["own_id", "no_id", "own_hash"]
    return held.join(stay, place, "left_semi").dropDuplicates(place).select("row.*")
