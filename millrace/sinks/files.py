"""Event files and Parquet tables as targets."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.schema import (
    DAY,
    INGEST_TIME,
    KEY,
    MALFORMED,
    MICROS,
    RAW_COLUMNS,
    RAW_SCHEMA,
    event_columns,
    event_schema,
)
from millrace.session import folders, read_lines, remove, replace_lines
from millrace.sources.files import QUOTING


def write_event_files(raw: DataFrame, path: str, mode: str = "append") -> None:
    """Raw rows as CSV files with a header; a file appears only once it is complete."""
    raw.select(*RAW_COLUMNS).write.mode(mode).option("header", True).options(**QUOTING).csv(path)


def write_arrivals(feed: DataFrame, path: str) -> None:
    """A feed as CSV, each `file_no` in a folder of its own.

    Rebalancing on `file_no` gives a small file number one file and splits one that holds
    much of the feed into several of the advisory size, so no task writes a hot one alone.
    """
    rows = feed.hint("rebalance", "file_no")
    rows.write.partitionBy("file_no").option("header", True).options(**QUOTING).csv(path)


def _by_day(rows: DataFrame) -> DataFrameWriter:
    ordered = rows.hint("rebalance", DAY).sortWithinPartitions(DAY, "user_id", "event_time")
    writer = ordered.write.partitionBy(DAY)
    return writer.option("parquet.bloom.filter.enabled#product_id", "true")


def write_lookup_table(events: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Events laid out for lookups by time, user, product and action.

    Days are folders (pruned by the time range), rows within a file are ordered by user
    (row groups are skipped by their statistics), products have a bloom filter per row group.
    Rebalancing splits a hot day over several tasks and files.
    """
    _by_day(events.withColumn(DAY, F.to_date("event_time"))).mode(mode).parquet(path)


# Columns of the curve, and the bits that each is cut to.
CURVE = ("user_id", "product_id", "event_time")
CURVE_BITS = 6


def _rank(number: Column, cuts: list[int], bits: int) -> Column:
    """How many of the cuts (2**bits - 1, in order) are below a number, by halving."""
    held = F.array(*(F.lit(cut).cast("long") for cut in cuts))
    jumps = F.array(*(F.lit(1 << i) for i in reversed(range(bits))))

    def step(at: Column, jump: Column) -> Column:
        return F.when(number > F.element_at(held, at + jump), at + jump).otherwise(at)

    return F.aggregate(jumps, F.lit(0), step)


def curve_place(
    events: DataFrame, columns: tuple[str, ...] = CURVE, bits: int = CURVE_BITS
) -> Column:
    """A column with each row's place on a Morton curve over the ranks of some columns.

    Each column is cut into 2**bits ranges that hold about equally many rows, whatever its
    values; the bits of the range numbers are dealt out in turn. One pass finds the cuts.
    """
    steps = 1 << bits
    shares = [i / steps for i in range(1, steps)]
    numbers = {
        name: F.unix_micros(name) if name == "event_time" else F.col(name).cast("long")
        for name in columns
    }
    found = events.agg(
        *(F.percentile_approx(x, shares, 100 * steps).alias(name) for name, x in numbers.items())
    ).first()
    place = F.lit(0).cast("long")
    for d, (name, number) in enumerate(numbers.items()):
        rank = _rank(number, found[name] or [0] * (steps - 1), bits)
        for i in range(bits):
            bit = F.shiftright(rank, i).bitwiseAND(F.lit(1)).cast("long")
            place = place.bitwiseOR(F.shiftleft(bit, len(columns) * i + d))
    return place


def write_curve_table(
    events: DataFrame, path: str, mode: str = "overwrite", group_rows: int = 100_000
) -> None:
    """Events along a space-filling curve, for lookups by user, by product and by time alike.

    Rows that are near in all three columns are near in the table, so the statistics of row
    groups let a lookup by any one of them skip most groups. Times are stored as numbers besides,
    since Parquet keeps no statistics of the form that Spark writes them in. Ranges are cut
    within equal places too (by the key), so one crowded place is several tasks.
    """
    rows = events.withColumns({"_place": curve_place(events), MICROS: F.unix_micros("event_time")})
    order = ("_place", *CURVE, KEY)
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("_place")
    rows.write.mode(mode).option("parquet.block.row.count.limit", group_rows).parquet(path)


def replay_days(events: DataFrame, path: str, days: Sequence[date]) -> None:
    """Write named days of a table laid out by day anew, and leave the others as they are.

    `events` are all events of these days (and may hold others, which are left out). A day that
    has none any more becomes empty.
    """
    spark, wanted = events.sparkSession, [F.lit(day) for day in days]
    rows = events.withColumn(DAY, F.to_date("event_time")).where(F.col(DAY).isin(*wanted))
    left = {row[0] for row in rows.select(DAY).distinct().collect()}  # some of the named days
    _by_day(rows).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    for day in set(days) - left:
        remove(spark, f"{path}/{DAY}={day.isoformat()}")


def create_event_table(spark: SparkSession, name: str, path: str) -> None:
    """Create the stored table unless it exists. Creating it again changes nothing."""
    columns = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in event_schema())
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet LOCATION '{path}'")


def append_to_table(events: DataFrame, name: str) -> None:
    """Append to a table of the catalog."""
    events.select(*event_columns()).write.insertInto(name)


def reject_schema(ingest_time: str = INGEST_TIME) -> T.StructType:
    """Schema of rejected rows: as they arrived, when they did, and the rule they broke."""
    fields = T.StructType([*RAW_SCHEMA.fields]).add(MALFORMED, "string")
    return fields.add(ingest_time, "timestamp").add("reason", "string")


class BatchTable:
    """A Parquet table with one folder per micro-batch.

    Writing a batch replaces its folder, so a replayed batch leaves the same rows once. Folders of
    batches that are done with can be merged (`compact`): their rows go to an archive of few
    files, sorted by batch, and a small file names the archives that count, so that readers see
    a batch in one place, before and after.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType | None = None
    ) -> None:
        self.path = path
        fields = (schema or event_schema()).fields
        self.schema = T.StructType([*fields]).add("batch_id", "long")
        # Makes the folder and no file, so that the first batch finds a table to compare with.
        empty = spark.createDataFrame([], self.schema)
        empty.write.mode("append").partitionBy("batch_id").parquet(path)

    @property
    def _pointer(self) -> str:
        return f"{self.path}/_archives.json"

    def archives(self, spark: SparkSession) -> list[dict]:
        """The archives that count: their path, and the first batch that is not in them."""
        return [json.loads(line) for line in read_lines(spark, self._pointer)]

    def read(self, spark: SparkSession) -> DataFrame:
        """All batches, with their `batch_id`."""
        reader, merged = spark.read.schema(self.schema), self.archives(spark)
        rows = reader.parquet(self.path)
        if not merged:
            return rows
        old = reader.parquet(*(archive["path"] for archive in merged))
        return old.unionAll(rows.where(F.col("batch_id") >= merged[-1]["before"]))

    def folder(self, batch_id: int) -> str:
        return f"{self.path}/batch_id={batch_id}"

    def read_batches(self, spark: SparkSession, numbers: list[int]) -> DataFrame:
        """The rows of some batches; the folders of others are not opened.

        Of archives the statistics of row groups, which are sorted by batch, say where they are.
        """
        fields = T.StructType([field for field in self.schema if field.name != "batch_id"])
        merged = self.archives(spark)
        before = merged[-1]["before"] if merged else 0
        names = [field.name for field in fields]
        parts = []
        if fresh := [number for number in numbers if number >= before]:
            parts.append(spark.read.schema(fields).parquet(*map(self.folder, fresh)))
        if old := [number for number in numbers if number < before]:
            low = 0
            for archive in merged:
                if any(low <= number < archive["before"] for number in old):
                    rows = spark.read.schema(self.schema).parquet(archive["path"])
                    parts.append(rows.where(F.col("batch_id").isin(old)).select(*names))
                low = archive["before"]
        return reduce(DataFrame.unionAll, parts)

    def replace(self, rows: DataFrame, batch_id: int) -> None:
        """Write a batch in place of what an earlier attempt left.

        Rebalancing gives a small batch one file, however many tasks its rows come from.
        """
        rows.hint("rebalance").write.mode("overwrite").parquet(self.folder(batch_id))

    def compact(self, spark: SparkSession, before: int) -> int:
        """Merge the folders of batches below a number, which must be committed; how many.

        Only what is new is rewritten. The folders stay until the next call, for readers that
        listed them.
        """
        merged = self.archives(spark)
        done = merged[-1]["before"] if merged else 0
        found = sorted(
            int(name.partition("=")[2]) for name in folders(spark, self.path) if name.startswith("batch_id=")
        )
        for number in found:
            if number < done:
                remove(spark, self.folder(number))
        wanted = [number for number in found if done <= number < before]
        if not wanted:
            return 0
        rows = spark.read.schema(self.schema).option("basePath", self.path)
        rows = rows.parquet(*map(self.folder, wanted))
        target = f"{self.path}/_archive/before-{before}-{uuid.uuid4().hex}"
        ordered = rows.repartitionByRange("batch_id", rows.columns[0])
        ordered.sortWithinPartitions("batch_id").write.parquet(target)
        lines = [*merged, {"path": target, "before": before}]
        replace_lines(spark, self._pointer, [json.dumps(line) for line in lines])
        return len(wanted)
