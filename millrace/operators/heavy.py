"""Heavy values of a column, and a join that spreads their rows.

Space-saving counters name every value that holds more than a share of all rows. A task keeps a
fixed number of counters; when there are more values, the largest count that has no room is taken
off all counters, which is the mergeable form of letting a new value take over the smallest one.
So a count is too low by at most rows / counters, also after counts of all tasks are added up,
and a value above the share cannot be missed. What is named is then counted exactly.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class SpaceSaving:
    """At most `size` counters, each too low by at most `taken`."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.counts: dict = {}
        self.rows = 0
        self.taken = 0

    def add(self, values: list, counts: list[int]) -> None:
        """Different values with their counts."""
        held = self.counts
        for value, count in zip(values, counts, strict=True):
            held[value] = held.get(value, 0) + count
            self.rows += count
        if len(held) > self.size:
            off = heapq.nlargest(self.size + 1, held.values())[-1]
            self.counts = {value: count - off for value, count in held.items() if count > off}
            self.taken += off


def _counters(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, kind = SpaceSaving(size), None
        for batch in batches:
            kind = batch.schema.field(0).type
            found = pc.value_counts(batch.column(0).drop_null())
            counters.add(found.field("values").to_pylist(), found.field("counts").to_pylist())
        if counters.rows:
            values = [*counters.counts, None]  # the last row says how many rows there were
            counts = [*counters.counts.values(), counters.rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, kind), pa.array(counts, pa.int64())], names=["value", "n"]
            )

    return count


def heavy_values(rows: DataFrame, column: str, share: float) -> DataFrame:
    """Values that more than `share` of all rows with a value have, and how many: value, n.

    At most 1 / share of them. Missing values are not counted.
    """
    size = math.ceil(2 / share)
    kind = rows.schema[column].dataType.simpleString()
    counted = rows.select(column).mapInArrow(_counters(size), f"value {kind}, n long")
    sums = counted.groupBy("value").agg(F.sum("n").alias("n")).persist()
    try:
        whole = sums.where("value IS NULL").first()
        total = whole["n"] if whole else 0
        # Counts of all tasks together are too low by half the share at most.
        least = total * share / 2
        named = [r["value"] for r in sums.where((F.col("n") >= least) & F.col("value").isNotNull()).collect()]
    finally:
        sums.unpersist()
    exact = rows.where(F.col(column).isin(named)).groupBy(F.col(column).alias("value"))
    return exact.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > total * share)


def salted_join(
    rows: DataFrame,
    others: DataFrame,
    column: str,
    heavy: list,
    pieces: int,
    spread_by: Column,
    how: str = "left",
) -> DataFrame:
    """A join on a column that both have, with rows of heavy values spread over several tasks.

    Rows of a heavy value are dealt out by a hash of `spread_by` (which should tell them apart);
    the other side's rows of heavy values alone are repeated, once per piece.
    """
    is_heavy = F.coalesce(F.col(column).isin(heavy), F.lit(False))
    piece = F.when(is_heavy, F.pmod(F.xxhash64(spread_by), F.lit(pieces)).cast("int")).otherwise(0)
    copies = F.sequence(F.lit(0), F.when(is_heavy, pieces - 1).otherwise(0))
    left = rows.withColumn("_piece", piece)
    right = others.withColumn("_piece", F.explode(copies))
    return left.join(right, [column, "_piece"], how).drop("_piece")
