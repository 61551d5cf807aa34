"""What happens to one micro-batch: deduplicate, write, measure."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.connection import Database
from millrace.functions.rules import reject_reason, rules
from millrace.operators.clean import clean
from millrace.operators.dedup import one_per_key
from millrace.operators.summaries import summarise
from millrace.schema import INGEST_TIME, KEY
from millrace.session import kept
from millrace.sinks import database as db
from millrace.sinks.files import BatchTable
from millrace.sinks.filters import KeyFilters
from millrace.streaming.metrics import BatchMetric, MetricsLog, RejectLog


class Batch(NamedTuple):
    """A micro-batch: its number and the stream it belongs to, the same when it is replayed."""

    number: int
    stream: str


# Writes the deduplicated rows of a batch and returns how many the batch added.
Writer = Callable[[DataFrame, Batch], int]
Handler = Callable[[DataFrame, int], None]


def stream_id(rows: DataFrame, checkpoint_dir: str) -> str:
    """The identity that a checkpoint gives its stream; it outlives restarts."""
    return rows.sparkSession.read.text(f"{checkpoint_dir}/metadata").first()[0]


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution while a batch is written, also in a stream whose own plan has none.

    Streams with state plan without it. What is done with a batch's rows is an ordinary job, and
    should merge small partitions, or a small batch ends in as many files as there are of state.
    """
    name = "spark.sql.adaptive.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def batch_callback(
    write: Writer, metrics: MetricsLog, checkpoint_dir: str, unique: bool = False
) -> Handler:
    """A callback for foreachBatch. The time covers dedup and write, not the emptiness test.

    `unique` says that the stream has left one row of each key already.
    """
    named: list[str] = []

    def handle(batch: DataFrame, batch_id: int) -> None:
        if not named:
            named.append(stream_id(batch, checkpoint_dir))
        if batch.isEmpty():
            metrics.add(batch.sparkSession, batch_id, BatchMetric(0, 0.0, skipped=True))
            return
        start = time.monotonic()
        with adaptive(batch.sparkSession):
            rows = write(batch if unique else one_per_key(batch), Batch(batch_id, named[0]))
        metrics.add(batch.sparkSession, batch_id, BatchMetric(rows, time.monotonic() - start))

    return handle


def split_callback(
    write: Writer,
    rejected: BatchTable,
    metrics: MetricsLog,
    checkpoint_dir: str,
    ingest_time: str = INGEST_TIME,
    strict_time: bool = False,
    counted: RejectLog | None = None,
    unique: bool = False,
) -> Handler:
    """A callback for raw batches: valid rows go on to `write`, the others to `rejected`.

    The batch is kept while both halves are written, so its files are parsed once. `counted`
    notes how many rows broke each rule, counted while the rejected rows are written.
    """
    handle = batch_callback(write, metrics, checkpoint_dir, unique)

    def split(batch: DataFrame, batch_id: int) -> None:
        with adaptive(batch.sparkSession), kept(batch) as raw:
            reason = reject_reason(strict_time, raw.columns)
            names = list(rules(strict_time, raw.columns))
            seen = Observation()
            rows = raw.withColumn("reason", reason).observe(
                seen,
                F.count(F.lit(1)).alias("rows"),
                *(F.count_if(F.col("reason") == name).alias(name) for name in names),
            )
            rejected.replace(rows.where("reason IS NOT NULL"), batch_id)
            if counted:
                counted.rows.put(batch.sparkSession, batch_id, seen.get)
            handle(clean(raw, ingest_time, strict_time), batch_id)

    return split


def to_table(table: BatchTable) -> Writer:
    """Write a batch to its folder of a Parquet table; rows are counted while they are written.

    Keys of other batches are not looked at: a stream that drops repeated keys before
    (`start_batches(unique=True)`) makes them unique over all batches, at a cost per batch that
    does not grow with the table.
    """

    def write(rows: DataFrame, batch: Batch) -> int:
        counted = Observation()
        table.replace(rows.observe(counted, F.count(F.lit(1)).alias("n")), batch.number)
        return counted.get["n"]

    return write


def to_unique_table(table: BatchTable, filters: KeyFilters) -> Writer:
    """Like `to_table`, without the keys that other batches of the table hold. Exact, no state.

    The filters say which batches may hold one of the keys; only the keys of those are read and
    compared. The row of a key is the smallest of the first batch that brings it. A batch stopped
    half way is written again as a whole: its own number is never asked.
    """

    def write(rows: DataFrame, batch: Batch) -> int:
        spark = rows.sparkSession
        # Rebalanced, so that a small batch is one task in each of the steps that follow.
        with kept(rows.hint("rebalance")) as held:
            others = filters.batches_for(held.select(KEY), but=batch.number)
            fresh = held
            if others:
                stored = table.read_batches(spark, others).select(KEY)
                fresh = held.join(stored, KEY, "left_anti").select(*held.columns)
            counted = Observation()
            fresh = fresh.observe(counted, F.count(F.lit(1)).alias("n"))
            table.replace(fresh, batch.number)
        added = counted.get["n"]
        if added:
            written = table.read_batches(spark, [batch.number])
            filters.add(written.select(KEY), batch.number, added)
        return added

    return write


def with_summaries(write: Writer, table: BatchTable, summaries: BatchTable) -> Writer:
    """Write a batch to `table`, and its figures (`operators/summaries.py`) beside it.

    The figures are made from what the batch stored, so they hold for any writer of the table; a
    batch that is written again replaces them.
    """

    def write_both(rows: DataFrame, batch: Batch) -> int:
        added = write(rows, batch)
        stored = table.read_batches(rows.sparkSession, [batch.number])
        summaries.replace(summarise(stored), batch.number)
        return added

    return write_both


def append_to(
    database: Database, table: str, connections: int = db.CONNECTIONS
) -> Writer:
    """Insert into a database table; a key of an earlier batch fails the batch as a whole."""

    def write(rows: DataFrame, batch: Batch) -> int:
        return db.merge(rows, database, table, False, connections, batch)

    return write


def merge_into(
    database: Database, table: str, connections: int = db.CONNECTIONS
) -> Writer:
    """Insert the rows whose key is new; replays and repeated deliveries add nothing."""

    def write(rows: DataFrame, batch: Batch) -> int:
        return db.merge(rows, database, table, True, connections, batch)

    return write


def to_all(*writers: Writer) -> Writer:
    """Several targets from one pass: the batch is computed once and kept until all are done.

    The count reported is that of the first target.
    """

    def write(rows: DataFrame, batch: Batch) -> int:
        with kept(rows) as shared:
            return [writer(shared, batch) for writer in writers][0]

    return write
