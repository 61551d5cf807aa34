"""Time the headline queries and the ingestion paths; prints one JSON line.

Every query runs twice into a sink that discards rows, in one warm session, and the faster run
counts. `ingest` has what the published numbers measure: rows after deduplication, seconds for
deduplication and write, rows per second, for one catch-up batch and for batches of 125 rows,
at the session's default number of shuffle partitions.
The database is embedded, so its figures are not those of a database server.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession

from millrace.connection import target
from millrace.operators.dedup import one_per_key
from millrace.plans.queries import QUERIES, TABLE
from millrace.schema import RAW_COLUMNS
from millrace.session import scratch, session
from millrace.sinks import database as db
from millrace.sinks.files import BatchTable, write_event_files
from millrace.sinks.filters import KeyFilters
from millrace.sources.feed import raw_feed
from millrace.sources.files import QUOTING
from millrace.streaming import batches, jobs
from millrace.streaming.metrics import MetricsLog, ProgressLog, read_metrics, read_triggers

HEADLINES = (
    "action_counts",
    "clean_events",
    "dedup_events",
    "latest_events",
    "reject_reasons",
    "constraint_audit",
    "time_range_lookup",
    "csv_roundtrip",
    "jdbc_append_roundtrip",
    "jdbc_subquery",
    "stream_parquet",
    "stream_unique_parquet",
    "stream_batch_sink",
    "stream_unique_batch_sink",
    "stream_to_database",
    "kept_counts",
    "curve_lookups",
    "heavy_products",
    "replayed_days",
    "mixed_headers",
)
ROUNDS = 2
# Rows and number of the small files of which each is a batch.
SMALL_BATCH = 125
SMALL_BATCHES = 40
# The same for batches whose keys are compared by filters, whose number of filters grows.
FILTERED_BATCHES = 100


def discard(rows: DataFrame) -> None:
    rows.write.format("noop").mode("overwrite").save()


def time_queries(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    best: dict[str, float] = {}
    for _ in range(ROUNDS):
        for name in HEADLINES:
            start = time.monotonic()
            discard(QUERIES[name](spark, sf_dir))
            best[name] = min(best.get(name, float("inf")), time.monotonic() - start)
    return {name: round(seconds, 3) for name, seconds in best.items()}


def targets(spark: SparkSession) -> dict[str, batches.Writer]:
    table = f"{TABLE}_{time.time_ns()}"
    database = target(spark, table)
    db.create_event_table(spark, database, table)
    return {
        "database": batches.merge_into(database, table),
        "files": batches.to_table(BatchTable(spark, scratch(spark, "bench"))),
        "filtered_files": batches.to_unique_table(
            BatchTable(spark, scratch(spark, "bench")), KeyFilters(scratch(spark, "filters"))
        ),
    }


def ingest(
    spark: SparkSession,
    folder: str,
    write: batches.Writer,
    max_files: int | None,
    unique: bool = False,
) -> dict:
    """Drain a folder; medians of the batches after the first few, which compile code.

    `trigger_s` is the whole trigger, with listing, planning and commits. `drift` compares the
    last quarter of the batches with the quarter after the first: 1 means that a batch does not
    get slower as the table grows.
    """
    path, triggers = scratch(spark, "metrics"), scratch(spark, "triggers")
    name = f"bench_{time.time_ns()}"
    job = jobs.StreamJob(folder, scratch(spark, "progress"), None, max_files, name=name)
    listener = ProgressLog(spark, triggers, name)
    jobs.start_batches(
        spark, job, write, MetricsLog(path), unique, progress=listener
    ).awaitTermination()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    rows = sorted(read_metrics(spark, path).collect())  # one row per batch
    whole = sorted(read_triggers(spark, triggers).collect())
    quarter = len(rows) // 4
    settled = rows[quarter:]
    found = {
        "batches": len(rows),
        "rows": statistics.median(row.rows for row in settled),
        "seconds": round(statistics.median(row.seconds for row in settled), 3),
        "rows_per_s": round(statistics.median(row.rows_per_s for row in settled), 1),
        "trigger_s": round(statistics.median(row.trigger_s for row in whole[quarter:]), 3),
    }
    if quarter > 2:
        first, last = rows[quarter : 2 * quarter], rows[-quarter:]
        first, last = (statistics.median(row.seconds for row in part) for part in (first, last))
        found["drift"] = round(last / first, 2)
    return found


def time_ingest(spark: SparkSession, sf_dir: str) -> dict[str, dict]:
    """One catch-up batch of the whole feed, and small batches of part of it.

    The small files hold the first events by id, SMALL_BATCH in each, which is a choice of the
    measurement: draining the whole feed so would only repeat the same batch.
    """
    feed = raw_feed(spark, sf_dir)
    backlog = scratch(spark, "backlog")
    write_event_files(feed.repartition(spark.sparkContext.defaultParallelism), backlog)

    few = one_per_key(feed.where("action IN ('view', 'purchase')")).select(*RAW_COLUMNS)
    few = few.where("event_id IS NOT NULL").orderBy("event_id")

    def trickle(count: int) -> str:
        path = scratch(spark, "trickle")
        rows = few.limit(SMALL_BATCH * count).repartition(1)
        writer = rows.write.option("header", True).option("maxRecordsPerFile", SMALL_BATCH)
        writer.options(**QUOTING).csv(path)
        return path

    found, short, long = {}, trickle(SMALL_BATCHES), trickle(FILTERED_BATCHES)
    for name in ("database", "files", "unique_files", "filtered_files"):
        unique = name == "unique_files"
        sink = name.removeprefix("unique_")
        small = long if name == "filtered_files" else short
        ingest(spark, backlog, targets(spark)[sink], None, unique)  # warm-up
        found[f"catch_up_{name}"] = ingest(spark, backlog, targets(spark)[sink], None, unique)
        found[f"steady_{name}"] = ingest(spark, small, targets(spark)[sink], 1, unique)
    return found


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.shuffle.partitions", cpus)
    times = time_queries(spark, sf_dir)
    spark.conf.unset("spark.sql.shuffle.partitions")
    report = {
        "metric": "headline queries, faster of two runs each",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "ingest": time_ingest(spark, sf_dir),
    }
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
