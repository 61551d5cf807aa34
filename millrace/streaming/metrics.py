"""Rows of metrics: one per micro-batch, and one per trigger from Spark's own progress."""

from __future__ import annotations

import json
import logging
import threading
from collections.abc import Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from millrace.session import read_lines, replace_lines

log = logging.getLogger("millrace")

# Log lines of a batch.
WRITTEN = "batch %d: %d rows | %.2fs | %.1f rows/s"
SKIPPED = "batch %d: 0 rows (skipped)"

METRICS_SCHEMA = "batch_id long, rows long, seconds double, rows_per_s double, skipped boolean"
TRIGGERS_SCHEMA = "batch_id long, input_rows long, trigger_s double, rows_per_s double"

# Batches whose rows share a file: at a batch every 5 seconds, 18 files a day.
BATCHES_PER_FILE = 1000


class RowLog:
    """Rows by batch number, as JSON lines in few files, written by the driver.

    The file of a group of batches is replaced as a whole when a row is added, under a temporary
    name first, so a reader never sees half of it and a replayed batch replaces its row.
    """

    def __init__(self, path: str) -> None:
        self.path = path
        self.group: int | None = None
        self.rows: dict[int, dict] = {}
        self.lock = threading.Lock()

    def put(self, spark: SparkSession, batch_id: int, row: dict) -> None:
        with self.lock:
            group = batch_id // BATCHES_PER_FILE
            name = f"{self.path}/batches_{group:08d}.json"
            if group != self.group:
                self.rows = {r["batch_id"]: r for r in map(json.loads, read_lines(spark, name))}
                self.group = group
            self.rows[batch_id] = {"batch_id": batch_id, **row}
            replace_lines(spark, name, [json.dumps(self.rows[n]) for n in sorted(self.rows)])


@dataclass(frozen=True)
class BatchMetric:
    """What one batch wrote and how long deduplicating and writing took."""

    rows: int
    seconds: float
    skipped: bool = False

    @property
    def rows_per_s(self) -> float:
        return self.rows / self.seconds if self.seconds > 0 else float(self.rows)


class MetricsLog:
    """Logs every batch, also a skipped one, and keeps its row if given a folder."""

    def __init__(self, path: str | None = None) -> None:
        self.rows = RowLog(path) if path else None

    def add(self, spark: SparkSession, batch_id: int, metric: BatchMetric) -> None:
        if metric.skipped:
            log.info(SKIPPED, batch_id)
        else:
            log.info(WRITTEN, batch_id, metric.rows, metric.seconds, metric.rows_per_s)
        if self.rows:
            row = asdict(metric) | {"rows_per_s": metric.rows_per_s}
            self.rows.put(spark, batch_id, row)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The rows a `MetricsLog` kept."""
    return spark.read.schema(METRICS_SCHEMA).json(path)


class RejectLog:
    """Keeps for each batch how many rows it had and how many broke each rule first."""

    def __init__(self, path: str) -> None:
        self.rows = RowLog(path)


def read_reject_counts(spark: SparkSession, path: str, reasons: Iterable[str]) -> DataFrame:
    """The rows a `RejectLog` kept: batch_id, rows, and a column per reason."""
    counts = ", ".join(f"{reason} long" for reason in reasons)
    return spark.read.schema(f"batch_id long, rows long, {counts}").json(path)


class ProgressLog(StreamingQueryListener):
    """Keeps the figures of every trigger of one query that had input, from its start to its end.

    Add it before the query starts (`spark.streams.addListener`). Spark itself remembers only
    the last hundred triggers.
    """

    def __init__(self, spark: SparkSession, path: str, name: str | None = None) -> None:
        super().__init__()
        self.spark, self.name, self.rows = spark, name, RowLog(path)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        made = event.progress
        if made.numInputRows and self.name in (None, made.name):
            row = {
                "input_rows": made.numInputRows,
                "trigger_s": made.durationMs["triggerExecution"] / 1000,
                "rows_per_s": made.processedRowsPerSecond,
            }
            self.rows.put(self.spark, made.batchId, row)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_triggers(spark: SparkSession, path: str) -> DataFrame:
    """The rows a `ProgressLog` kept."""
    return spark.read.schema(TRIGGERS_SCHEMA).json(path)
