"""Exact duplicates through counting quotient filters.

Every partition builds a counting quotient filter over the 64-bit fingerprints of its texts: the
upper bits of a fingerprint (quotient) name a slot run, the lower bits (remainder) are kept in
sorted order within the run with a count. Filters of the same quotients merge without loss by
merging their sorted remainders and adding counts. Only texts whose fingerprint counts more than
one are compared byte by byte.

Defined results
* null text counts as empty, so null and empty texts are copies of each other;
* of equal texts the largest doc_id stays; a null id never wins over another, and where all ids
  of a group are null, keep_id is null and its rows are kept;
* repeated rows (same id, same text) share one verdict;
* other columns, whatever their names, are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.textops import prepare
from millrace.session import scratch

REMAINDER_BITS = 32
# Fingerprints per segment that merging tasks should see, for sizing their number.
SEGMENT_ROWS = 1 << 18


@dataclass
class CountingQuotientFilter:
    """Runs of sorted remainders with counts.

    quotients holds the occupied quotients in order, run_ends the end of each one's run, and
    remainders and counts the runs themselves: the three columns of a quotient filter with its
    slots in order and the offsets kept outright.
    """

    quotients: np.ndarray
    run_ends: np.ndarray
    remainders: np.ndarray
    counts: np.ndarray

    @classmethod
    def of_counts(cls, fingerprints: np.ndarray, counts: np.ndarray) -> CountingQuotientFilter:
        """A filter of fingerprints (uint64, any order, repeats allowed) with their counts."""
        order = np.argsort(fingerprints, kind="stable")
        ordered = fingerprints[order]
        first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]][: len(ordered)])
        total = np.add.reduceat(counts[order], first) if len(first) else counts[:0]
        distinct = ordered[first]
        quotient = (distinct >> np.uint64(REMAINDER_BITS)).astype(np.uint32)
        last = np.flatnonzero(np.r_[quotient[1:] != quotient[:-1], True][: len(quotient)])
        return cls(quotient[last], last + 1, distinct.astype(np.uint32), total.astype(np.int64))

    @classmethod
    def of(cls, fingerprints: np.ndarray) -> CountingQuotientFilter:
        return cls.of_counts(fingerprints, np.ones(len(fingerprints), np.int64))

    def fingerprints(self) -> np.ndarray:
        """All fingerprints in order, from quotient and remainder."""
        lengths = np.diff(np.r_[0, self.run_ends])
        upper = np.repeat(self.quotients.astype(np.uint64), lengths)
        return (upper << np.uint64(REMAINDER_BITS)) | self.remainders.astype(np.uint64)

    @classmethod
    def merge(cls, filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        """The filter of all that the given ones hold; counts add up, nothing is lost."""
        return cls.of_counts(
            np.concatenate([f.fingerprints() for f in filters]),
            np.concatenate([f.counts for f in filters]),
        )

    def repeated(self) -> np.ndarray:
        """Fingerprints counted more than once."""
        return self.fingerprints()[self.counts > 1]

    def segments(self, parts: int) -> Iterator[tuple[int, bytes, bytes, bytes, bytes]]:
        """The filter cut at quotients into ranges that all filters share."""
        width = -(-(1 << 32) // parts)
        owner = (self.quotients.astype(np.int64) // width).astype(np.int64)
        run_starts = np.r_[0, self.run_ends[:-1]]
        cuts = np.searchsorted(owner, np.arange(parts + 1))
        for part in np.unique(owner):
            low, high = cuts[part], cuts[part + 1]
            a, b = run_starts[low], self.run_ends[high - 1]
            yield (
                int(part),
                self.quotients[low:high].tobytes(),
                (self.run_ends[low:high] - a).astype(np.int64).tobytes(),
                self.remainders[a:b].tobytes(),
                self.counts[a:b].tobytes(),
            )

    @classmethod
    def from_segment(cls, row) -> CountingQuotientFilter:
        return cls(
            np.frombuffer(row.quotients, np.uint32),
            np.frombuffer(row.run_ends, np.int64),
            np.frombuffer(row.remainders, np.uint32),
            np.frombuffer(row.counts, np.int64),
        )


SEGMENT = "part int, quotients binary, run_ends binary, remainders binary, counts binary"
# Repeated fingerprints, of 8 bytes, that are sent to every task at most.
BROADCAST_FINGERPRINTS = 1 << 20
# Fingerprints a partition's filter takes in before it is handed on; further ones start another,
# and all are merged. So memory stays bounded however large a partition is.
FILTER_ROWS = 1 << 20


def _build(parts: int):
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def hand_on(held: list[np.ndarray]) -> pa.RecordBatch:
            rows = list(CountingQuotientFilter.of(np.concatenate(held)).segments(parts))
            kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
            names = ("part", "quotients", "run_ends", "remainders", "counts")
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=names)

        held, size = [], 0
        for batch in batches:
            found = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            if len(found):
                held.append(found)
                size += len(found)
            if size >= FILTER_ROWS:
                yield hand_on(held)
                held, size = [], 0
        if held:
            yield hand_on(held)

    return build


def _merge(segments: pd.DataFrame) -> pd.DataFrame:
    filters = [CountingQuotientFilter.from_segment(row) for row in segments.itertuples()]
    repeated = CountingQuotientFilter.merge(filters).repeated()
    return pd.DataFrame({"fingerprint": repeated.view(np.int64)})


def repeated_fingerprints(fingerprints: DataFrame, parts: int) -> DataFrame:
    """Fingerprints (one long column) that occur more than once."""
    segments = fingerprints.mapInArrow(_build(parts), SEGMENT)
    return segments.groupBy("part").applyInPandas(_merge, "fingerprint long")


def exact_duplicates(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = documents.sparkSession
    prepare(spark)
    text = F.coalesce(F.col("text"), F.lit(""))
    texts = documents.select(
        "doc_id",
        text.alias("text"),
        F.xxhash64(text).alias("fingerprint"),
    )
    digests = texts.select("doc_id", "fingerprint", F.sha2("text", 256).alias("text_sha256"))
    path = scratch(spark, "exact-dedup")
    digests.write.parquet(path)
    rows = spark.read.parquet(path)

    parts = max(spark.sparkContext.defaultParallelism, -(-rows.count() // SEGMENT_ROWS))
    repeated = repeated_fingerprints(rows.select("fingerprint"), parts)
    path = scratch(spark, "repeated-fingerprints")
    repeated.write.parquet(path)
    repeated = spark.read.parquet(path)
    # While they are few, every task has all repeated fingerprints and no other text is moved;
    # beyond that, texts are joined with them by the fingerprint.
    if repeated.count() <= BROADCAST_FINGERPRINTS:
        repeated = F.broadcast(repeated)
    # Byte verification: equal bytes are one group, so no two different texts ever share one.
    # Copies within a task are one row before the shuffle.
    suspects = texts.join(repeated, "fingerprint", "left_semi")
    groups = (
        suspects.groupBy("text")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
        .select(F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size")
    )
    joined = rows.join(groups, "text_sha256", "left")
    alone = F.col("group_size").isNull()
    keep_id = F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        "text_sha256",
    )
