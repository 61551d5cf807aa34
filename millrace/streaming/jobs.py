"""Streaming jobs: watch a folder, clean, and deliver to files, a database or the console."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import nullcontext
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from millrace.functions.rules import is_valid, reject_reason
from millrace.operators.clean import clean
from millrace.schema import INGEST_TIME, KEY, event_schema
from millrace.session import kept, settings
from millrace.sinks.files import BatchTable
from millrace.sources.by_name import named_events, watch_lines
from millrace.sources.files import watch_events
from millrace.streaming.batches import (
    Writer,
    adaptive,
    batch_callback,
    split_callback,
    to_table,
)
from millrace.streaming.memory import LATE, STORED, remembered
from millrace.streaming.metrics import MetricsLog, ProgressLog, RejectLog

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@dataclass(frozen=True)
class StreamJob:
    """Where a stream reads, where it keeps its progress, and how much a batch may take."""

    input_dir: str
    checkpoint_dir: str
    # None: process what is waiting, then stop.
    trigger_seconds: int | None = 5
    max_files: int | None = None
    max_bytes: str | None = None
    ingest_time: str = INGEST_TIME
    strict_time: bool = False
    strict_header: bool = False
    # Line breaks within quoted fields; files are then not split.
    multi_line: bool = False
    # For the progress that a listener sees.
    name: str | None = None

    def raw(self, spark: SparkSession) -> DataFrame:
        """The stream as it arrives."""
        return watch_events(
            spark,
            self.input_dir,
            self.max_files,
            self.max_bytes,
            self.strict_header,
            self.multi_line,
        )

    def events(self, spark: SparkSession) -> DataFrame:
        """The cleaned stream."""
        return clean(self.raw(spark), self.ingest_time, self.strict_time)

    def trigger(self, writer: DataStreamWriter) -> DataStreamWriter:
        if self.trigger_seconds is None:
            return writer.trigger(availableNow=True)
        return writer.trigger(processingTime=f"{self.trigger_seconds} seconds")

    def started(self, events: DataFrame) -> DataStreamWriter:
        """A writer for `events` with this job's output mode, checkpoint and trigger."""
        writer = events.writeStream.outputMode("append")
        if self.name:
            writer = writer.queryName(self.name)
        return self.trigger(writer.option("checkpointLocation", self.checkpoint_dir))


# Bytes of rows that a task holds before it hands on the smallest of each key.
HELD_BYTES = 16 << 20


def _smallest(parts: list[pa.Table]) -> pa.Table:
    """Of each key the smallest row, compared column by column, missing values first."""
    rows = pa.concat_tables(parts).combine_chunks()
    names = [KEY, *(name for name in rows.column_names if name != KEY)]
    order = [(name, "ascending") for name in names]
    rows = rows.take(pc.sort_indices(rows, sort_keys=order, null_placement="at_start"))
    codes = rows[KEY].combine_chunks().dictionary_encode().indices.to_numpy()
    return rows.filter(pa.array(np.r_[True, codes[1:] != codes[:-1]][: len(rows)]))


def _thin(batches: Iterator[pa.RecordBatch], held_bytes: float = HELD_BYTES):
    """The smallest row of each key, as far as the rows that a task may hold show it."""
    held: list[pa.Table] = []
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        if sum(part.nbytes for part in held) >= held_bytes:
            held = [_smallest(held)]
            if held[0].nbytes >= held_bytes / 2:  # mostly different keys
                yield from held.pop().to_batches()
    if held:
        yield from _smallest(held).to_batches()


def _one_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The smallest row of each key of a partition."""
    held: list[pa.Table] = []
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        if sum(part.nbytes for part in held[1:]) >= max(HELD_BYTES, held[0].nbytes):
            held = [_smallest(held)]
    if held:
        yield from _smallest(held).to_batches()


def one_per_batch(events: DataFrame) -> DataFrame:
    """Of each key the smallest row of a batch of the stream.

    Copies go before the shuffle, as a key may fill much of a batch; after it a task holds each
    key of its part of the batch once, which `max_files` or `max_bytes` bounds.
    """
    # Without the metadata by which Spark would know the column of a watermark.
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in events.schema])
    return events.mapInArrow(_thin, schema).repartition(KEY).mapInArrow(_one_each, schema)


def first_seen(events: DataFrame) -> DataFrame:
    """Drop repeated keys across all batches, with the keys seen so far as stream state.

    Every key is remembered, so the result is exact whatever the order of event times, and work
    per batch grows with the batch, not with the table. A key's row is that of the first batch
    that brings it, and of several copies within that batch the smallest.
    """
    return one_per_batch(events).dropDuplicates([KEY])


def start_files(spark: SparkSession, job: StreamJob, path: str) -> StreamingQuery:
    """Events to Parquet, each exactly once per delivery."""
    return job.started(job.events(spark)).format("parquet").start(path)


def _unique(spark: SparkSession, state_partitions: int | None) -> dict[str, str]:
    """Settings of a stream with state; the first start of a checkpoint fixes the partitions."""
    partitions = state_partitions or spark.sparkContext.defaultParallelism
    return STATE_STORE | {"spark.sql.shuffle.partitions": str(partitions)}


def start_unique_files(
    spark: SparkSession, job: StreamJob, path: str, state_partitions: int | None = None
) -> StreamingQuery:
    """Events to a Parquet table by batch, each key exactly once.

    Without a number, there are as many state partitions as cores; choose more for many keys.
    A small batch becomes one file.
    """
    table = BatchTable(spark, path, event_schema(job.ingest_time))
    return start_batches(
        spark, job, to_table(table), unique=True, state_partitions=state_partitions
    )


def start_remembered(
    spark: SparkSession,
    job: StreamJob,
    table: BatchTable,
    late: BatchTable,
    horizon: str,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Each key once in `table`, with keys remembered for a horizon of event time.

    Of a key's copies in a batch the smallest stands for all. It is stored unless the key is
    remembered. Events older than the newest event time of earlier batches less the horizon go
    to `late`, one per key and batch: no key is lost, and state stays bounded.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        with adaptive(batch.sparkSession), kept(batch) as rows:
            for target, fate in ((table, STORED), (late, LATE)):
                target.replace(rows.where(F.col("fate") == fate).drop("fate"), batch_id)

    with settings(spark, _unique(spark, state_partitions)) as own:
        events = job.events(own).withWatermark("event_time", horizon)
        return job.started(remembered(one_per_batch(events))).foreachBatch(handle).start()


def start_console(spark: SparkSession, job: StreamJob, rows: int = 20) -> StreamingQuery:
    """The newest rows on the console, untruncated. Without progress: a restart shows all again."""
    writer = job.events(spark).writeStream.outputMode("append").format("console")
    return job.trigger(writer.option("truncate", False).option("numRows", rows)).start()


def start_batches(
    spark: SparkSession,
    job: StreamJob,
    write: Writer,
    metrics: MetricsLog | None = None,
    unique: bool = False,
    state_partitions: int | None = None,
    progress: ProgressLog | None = None,
) -> StreamingQuery:
    """Deduplicate each micro-batch and hand it to `write`.

    With `unique`, keys of earlier batches are dropped as well (`first_seen`); such a stream runs
    in a session of its own. `progress` listens in the session that the stream runs in.
    """
    handle = batch_callback(write, metrics or MetricsLog(), job.checkpoint_dir, unique)
    values = _unique(spark, state_partitions) if unique else {}
    with settings(spark, values) if unique else nullcontext(spark) as own:
        if progress:
            own.streams.addListener(progress)
        events = job.events(own)
        return job.started(first_seen(events) if unique else events).foreachBatch(handle).start()


def start_named_batches(
    spark: SparkSession, job: StreamJob, write: Writer, metrics: MetricsLog | None = None
) -> StreamingQuery:
    """Like `start_batches`, for files whose columns are found by the names in their headers.

    A batch holds whole files, so its lines are matched with the headers among them.
    """
    handle = batch_callback(write, metrics or MetricsLog(), job.checkpoint_dir)

    def named(batch: DataFrame, batch_id: int) -> None:
        with adaptive(batch.sparkSession), kept(batch) as lines:
            events = clean(named_events(lines).drop("others"), job.ingest_time, job.strict_time)
            handle(events, batch_id)

    lines = watch_lines(spark, job.input_dir, job.max_files)
    return job.started(lines).foreachBatch(named).start()


def start_split(
    spark: SparkSession,
    job: StreamJob,
    write: Writer,
    rejected: BatchTable,
    metrics: MetricsLog | None = None,
    unique: bool = False,
    state_partitions: int | None = None,
    counted: RejectLog | None = None,
) -> StreamingQuery:
    """Like `start_batches`, and rejected rows are kept with the reason.

    Rows are stamped in the stream, so a replayed batch has the ingest time it had before. With
    `unique`, valid rows with keys of earlier batches are dropped; rejected rows are all kept and
    are not part of the state. Both halves then read the batch's files.
    """
    handle = split_callback(
        write,
        rejected,
        metrics or MetricsLog(),
        job.checkpoint_dir,
        job.ingest_time,
        job.strict_time,
        counted,
        unique,
    )
    values = _unique(spark, state_partitions) if unique else {}
    with settings(spark, values) if unique else nullcontext(spark) as own:
        raw = job.raw(own).withColumn(job.ingest_time, F.current_timestamp())
        if unique:
            valid = raw.where(is_valid(job.strict_time, raw.columns))
            broken = raw.where(reject_reason(job.strict_time, raw.columns).isNotNull())
            raw = first_seen(valid).unionAll(broken)
        return job.started(raw).foreachBatch(handle).start()


def wait(queries: Sequence[StreamingQuery]) -> None:
    """Block until any of the queries ends; raise if it failed."""
    while not any(query.awaitTermination(1) for query in queries):
        pass
