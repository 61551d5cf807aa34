"""The registered queries: each takes a session and a table folder and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.connection import Database, target
from millrace.functions.rules import cast_lost, is_valid, rules, safe_columns
from millrace.operators import drift, heavy, report, summaries
from millrace.operators.audit import audit
from millrace.operators.clean import clean, default_ingest_time, rejects, strict_events
from millrace.operators.dedup import one_per_key
from millrace.schema import INGEST_TIME, RAW_COLUMNS, event_schema
from millrace.session import kept, remove, scratch
from millrace.sinks import database as db
from millrace.sinks import files
from millrace.sinks.filters import KeyFilters
from millrace.sources.by_name import named_events, read_events_by_name, watch_lines
from millrace.sources.database import read_database, read_table_in_ranges
from millrace.sources.feed import raw_feed
from millrace.sources.files import QUOTING, read_events, read_table
from millrace.streaming import batches, jobs
from millrace.streaming.memory import LATE, STORED
from millrace.streaming.metrics import (
    MetricsLog,
    ProgressLog,
    RejectLog,
    RowLog,
    read_metrics,
    read_reject_counts,
    read_triggers,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The feed arrives in waves: two of first deliveries, then the copies of events of both.
LAST_FILE_OF_FIRST_WAVE = 3
LAST_FILE_OF_SECOND_WAVE = 7

DAY = (datetime(2024, 1, 5), datetime(2024, 1, 6))
USER = 12
PRODUCT = 7

# Rows that one task reads from the database.
ROWS_PER_READ = 5_000

# Seconds between the first and the last event that a day's delivery may span.
DAY_SECONDS = 86_000

# Days that are written anew.
REPLAYED = (date(2024, 1, 5), date(2024, 1, 20))
# Products that more of the rows are about.
HEAVY_SHARE = 0.0105
# The delivery that has more rejected rows.
DAMAGED_FILE = 5
ROWS_PER_SECOND = 1000

# How long a stream remembers keys, in event time.
HORIZON = "20 days"

TABLE = "shop_events"


def query(function: Query) -> Query:
    """Register a query under its function's name."""
    QUERIES[function.__name__] = function
    return function


def comparable(events: DataFrame, *more: str) -> DataFrame:
    """Events without the ingest time, in types that other engines hand out alike."""
    return events.select(
        *more,
        *(F.col(name) for name in RAW_COLUMNS if name not in ("event_time", "price")),
        F.col("event_time").cast("timestamp_ntz").alias("event_time"),
        F.col("price").cast("double").alias("price"),
    )


def _clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(raw_feed(spark, sf_dir))


@contextmanager
def _stored_feed(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """The raw feed made once, for steps that each take some of its files."""
    feed, path = raw_feed(spark, sf_dir), scratch(spark, "feed")
    feed.write.partitionBy("file_no").parquet(path)
    yield spark.read.schema(feed.schema).parquet(path)
    remove(spark, path)


def _unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_per_key(_clean(spark, sf_dir))


# --- counts and rows -------------------------------------------------------------------------


@query
def action_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.action_counts(_clean(spark, sf_dir))


@query
def raw_feed_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.row_count(raw_feed(spark, sf_dir))


@query
def raw_feed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_feed(spark, sf_dir)


@query
def clean_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.row_count(_clean(spark, sf_dir))


@query
def distinct_event_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.distinct_keys(_clean(spark, sf_dir))


@query
def clean_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_clean(spark, sf_dir))


@query
def dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(_unique(spark, sf_dir))


@query
def latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = report.latest(_unique(spark, sf_dir), by="event_time")
    return comparable(newest).select("event_id", "action", "product_id", "source", "event_time")


@query
def strict_cast_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_feed(spark, sf_dir)
    return comparable(strict_events(raw.where(is_valid() & ~cast_lost("price"))))


@query
def default_stored_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _clean(spark, sf_dir)
    given = F.when(F.col("action") == "purchase", F.col(INGEST_TIME))
    filled = default_ingest_time(events.withColumn(INGEST_TIME, given))
    return filled.groupBy("action").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(INGEST_TIME).isNull()).alias("missing")
    )


# --- quality ---------------------------------------------------------------------------------


@query
def rejected_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rejects(raw_feed(spark, sf_dir))


@query
def reject_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = rejects(raw_feed(spark, sf_dir))
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query
def constraint_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(raw_feed(spark, sf_dir))


@query
def stored_constraint_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit of a table that was written, without a database to guard it, with violations.

    The table holds each delivery, so keys repeat, and has gaps in required columns.
    """
    path = scratch(spark, "audited")
    events = _clean(spark, sf_dir)
    number = F.col("event_id").substr(2, 20).cast("long")
    damaged = events.withColumns(
        {
            "user_id": F.when(number % 101 != 0, F.col("user_id")),
            "action": F.when(number % 103 == 0, "click").otherwise(F.col("action")),
            INGEST_TIME: F.when(number % 107 != 0, F.col(INGEST_TIME)),
        }
    )
    damaged.write.parquet(path)
    return audit(read_table(spark, path))


# --- lookups ---------------------------------------------------------------------------------


def _laid_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored events in a table laid out for lookups."""
    path = scratch(spark, "lookups")
    files.write_lookup_table(_unique(spark, sf_dir), path)
    return read_table(spark, path)


@query
def time_range_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(report.in_time_range(_laid_out(spark, sf_dir), *DAY))


@query
def user_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(report.of_user(_laid_out(spark, sf_dir), USER))


@query
def product_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(report.of_product(_laid_out(spark, sf_dir), PRODUCT))


@query
def action_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(report.of_action(_laid_out(spark, sf_dir), "purchase"))


@query
def stored_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of each lookup, on the layout made from what a stream stored."""
    stored, laid_out = scratch(spark, "events"), scratch(spark, "lookups")
    _deliver(spark, sf_dir, lambda job: jobs.start_unique_files(spark, job, stored))
    files.write_lookup_table(read_table(spark, stored).drop("batch_id"), laid_out)
    events = read_table(spark, laid_out)
    found = {
        "day": report.in_time_range(events, *DAY),
        "user": report.of_user(events, USER),
        "product": report.of_product(events, PRODUCT),
        "action": report.of_action(events, "purchase"),
    }
    parts = [comparable(rows).withColumn("lookup", F.lit(name)) for name, rows in found.items()]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])


@query
def curve_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of each lookup on a table laid out along a space-filling curve."""
    path = scratch(spark, "curve")
    files.write_curve_table(_unique(spark, sf_dir), path)
    events = read_table(spark, path)
    found = {
        "day": report.in_time_range(events, *DAY),
        "user": report.of_user(events, USER),
        "product": report.of_product(events, PRODUCT),
    }
    parts = [comparable(rows).withColumn("lookup", F.lit(name)) for name, rows in found.items()]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query
def heavy_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products that more than a share of the feed's rows are about, counted exactly."""
    return heavy.heavy_values(raw_feed(spark, sf_dir), "product_id", HEAVY_SHARE)


@query
def salted_product_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their product's name, joined with the rows of heavy products spread."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        "event_id", F.get_json_object("props", "$.k").cast("int").alias("product")
    )
    products = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        F.col("p_partkey").cast("int").alias("product"), F.col("p_name").alias("name")
    )
    many = [row.value for row in heavy.heavy_values(events, "product", HEAVY_SHARE).collect()]
    return heavy.salted_join(events, products, "product", many, 8, F.col("event_id"))


# --- files and tables ------------------------------------------------------------------------


@query
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "arrivals")
    files.write_arrivals(raw_feed(spark, sf_dir), path)
    return read_events(spark, path)


@query
def create_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of a table of the catalog that was created again after it was filled."""
    name, path = f"{TABLE}_{uuid.uuid4().hex}", scratch(spark, "catalog")
    files.create_event_table(spark, name, path)
    files.append_to_table(_unique(spark, sf_dir), name)
    files.create_event_table(spark, name, path)
    spark.table(name).isEmpty()  # the catalog's way to the rows works
    spark.sql(f"DROP TABLE {name}")  # its folder stays, the name does not
    return comparable(spark.read.schema(event_schema()).parquet(path))


@query
def replayed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table by day with two days damaged, after these days alone were written anew."""
    path = scratch(spark, "replayed")
    events = _unique(spark, sf_dir)
    bad = F.to_date("event_time").isin(*map(F.lit, REPLAYED))
    damaged = events.where(~bad | (F.col("user_id") % 2 == 0)).withColumn(
        "source", F.when(bad, "damaged").otherwise(F.col("source"))
    )
    files.write_lookup_table(damaged, path)
    files.replay_days(events, path, REPLAYED)
    return comparable(read_table(spark, path))


def _mixed_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The feed in files of three headers: another order, a column missing, one more."""
    shapes = {
        0: [F.col(name) for name in reversed(RAW_COLUMNS)],
        1: [F.col(name) for name in RAW_COLUMNS if name != "source"],
        2: [*map(F.col, RAW_COLUMNS[5:]), F.lit("v2").alias("app"), *map(F.col, RAW_COLUMNS[:5])],
    }
    with _stored_feed(spark, sf_dir) as feed:
        for shape, columns in shapes.items():
            rows = feed.where(F.col("file_no") % 3 == shape).select(*columns)
            rows.write.mode("append").option("header", True).options(**QUOTING).csv(path)


def _with_app(raw: DataFrame) -> DataFrame:
    """Valid events, with the column that only some files have."""
    valid = raw.where(is_valid(columns=raw.columns))
    typed = {name: x.alias(name) for name, x in safe_columns().items()}
    events = valid.select(*typed.values(), F.col("others")["app"].alias("app"))
    return comparable(events, "app")


@query
def mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid events of files whose columns come in different orders, read by name."""
    path = scratch(spark, "mixed")
    _mixed_files(spark, sf_dir, path)
    return _with_app(read_events_by_name(spark, path))


@query
def stream_mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a stream of lines; every batch matches them with the headers of its files."""
    path, out = scratch(spark, "mixed"), scratch(spark, "events")
    _mixed_files(spark, sf_dir, path)

    def handle(batch: DataFrame, batch_id: int) -> None:
        with kept(batch) as lines:
            _with_app(named_events(lines)).write.mode("overwrite").parquet(f"{out}/b={batch_id}")

    lines = watch_lines(spark, path, max_files=4)
    writer = lines.writeStream.option("checkpointLocation", scratch(spark, "progress"))
    writer.trigger(availableNow=True).foreachBatch(handle).start().awaitTermination()
    return read_table(spark, out).drop("b")


# --- database --------------------------------------------------------------------------------


def _database(spark: SparkSession) -> tuple[Database, str]:
    """A database with a new, empty event table."""
    table = f"{TABLE}_{uuid.uuid4().hex[:12]}"
    database = target(spark, table)
    db.create_event_table(spark, database, table)
    return database, table


def _stored(spark: SparkSession, database: Database, table: str) -> DataFrame:
    return read_table_in_ranges(spark, database, table, "event_id", ROWS_PER_READ)


@query
def jdbc_append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    database, table = _database(spark)
    db.append(_unique(spark, sf_dir), database, table)
    return comparable(_stored(spark, database, table))


@query
def jdbc_merge_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of a first delivery, then all: the second merge adds what is new."""
    database, table = _database(spark)
    feed = raw_feed(spark, sf_dir)
    early = feed.where(F.col("file_no") <= LAST_FILE_OF_FIRST_WAVE)
    added = [db.merge(one_per_key(clean(part)), database, table) for part in (early, feed)]
    return comparable(_stored(spark, database, table)).withColumns(
        {f"added_{i}": F.lit(n).cast("long") for i, n in enumerate(added, 1)}
    )


@query
def jdbc_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A grouped count that the database computes."""
    database, table = _database(spark)
    db.append(_unique(spark, sf_dir), database, table)
    counts = f"(SELECT action, COUNT(*) AS n FROM {table} GROUP BY action) t"
    return read_database(spark, database, counts).select("action", F.col("n").cast("long"))


@query
def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    database, table = _database(spark)
    events = _unique(spark, sf_dir)
    db.append(report.of_action(events, "view"), database, table)
    db.refresh(events, database, table)
    return comparable(_stored(spark, database, table))


# --- streams ---------------------------------------------------------------------------------


def _waves(spark: SparkSession, sf_dir: str, empty_wave: bool = False) -> list[DataFrame]:
    """The feed in three deliveries; if asked for, one without any valid row between them.

    Some events come twice within their delivery, the second time from another source.
    """
    sources = F.when(F.col("event_id").endswith("3"), F.array("source", F.lit("kiosk")))
    feed = raw_feed(spark, sf_dir).withColumn(
        "source", F.explode(sources.otherwise(F.array("source")))
    )
    file_no = F.col("file_no")
    first = feed.where(file_no <= LAST_FILE_OF_FIRST_WAVE)
    second = feed.where(file_no.between(LAST_FILE_OF_FIRST_WAVE + 1, LAST_FILE_OF_SECOND_WAVE))
    copies = feed.where(file_no > LAST_FILE_OF_SECOND_WAVE)
    invalid = [first.where(~F.coalesce(is_valid(), F.lit(False)))] if empty_wave else []
    return [first, *invalid, second, copies]


def _deliver(
    spark: SparkSession,
    sf_dir: str,
    run: Callable[[jobs.StreamJob], object],
    empty_wave: bool = False,
    name: str | None = None,
    waves: list[DataFrame] | None = None,
) -> jobs.StreamJob:
    """Bring the feed in waves and let the stream catch up, from its checkpoint, after each."""
    job = jobs.StreamJob(
        scratch(spark, "incoming"), scratch(spark, "progress"), trigger_seconds=None, name=name
    )
    for wave in waves or _waves(spark, sf_dir, empty_wave):
        files.write_event_files(wave, job.input_dir)
        run(job).awaitTermination()
    remove(spark, job.input_dir)
    return job


@query
def stream_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "events")
    _deliver(spark, sf_dir, lambda job: jobs.start_files(spark, job, path))
    return comparable(read_table(spark, path))


@query
def stream_unique_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "events")
    _deliver(spark, sf_dir, lambda job: jobs.start_unique_files(spark, job, path))
    return comparable(read_table(spark, path))


@query
def stream_batch_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches in folders of their own, unique over all of them by filters of their keys."""
    table = files.BatchTable(spark, scratch(spark, "batches"))
    write = batches.to_unique_table(table, KeyFilters(scratch(spark, "filters")))
    _deliver(spark, sf_dir, lambda job: jobs.start_batches(spark, job, write))
    return comparable(table.read(spark), "batch_id")


@query
def compacted_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, with the folders of earlier batches merged while the stream goes on."""
    table = files.BatchTable(spark, scratch(spark, "batches"))
    write = batches.to_unique_table(table, KeyFilters(scratch(spark, "filters")))

    def merging(rows: DataFrame, batch: batches.Batch) -> int:
        added = write(rows, batch)
        table.compact(rows.sparkSession, batch.number)  # earlier ones are committed
        return added

    _deliver(spark, sf_dir, lambda job: jobs.start_batches(spark, job, merging))
    return comparable(table.read(spark), "batch_id")


@query
def stream_unique_batch_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by stream state."""
    table = files.BatchTable(spark, scratch(spark, "batches"))
    write = batches.to_table(table)
    _deliver(spark, sf_dir, lambda job: jobs.start_batches(spark, job, write, unique=True))
    return comparable(table.read(spark), "batch_id")


@query
def stream_to_database(spark: SparkSession, sf_dir: str) -> DataFrame:
    database, table = _database(spark)
    write = batches.merge_into(database, table)
    _deliver(spark, sf_dir, lambda job: jobs.start_batches(spark, job, write))
    return comparable(_stored(spark, database, table))


@query
def stream_two_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pass, two targets: a file table unique per batch, a database unique over all."""
    folder = files.BatchTable(spark, scratch(spark, "batches"))
    database, table = _database(spark)
    write = batches.to_all(batches.to_table(folder), batches.merge_into(database, table))
    _deliver(spark, sf_dir, lambda job: jobs.start_batches(spark, job, write))
    sinks = {"files": folder.read(spark), "database": _stored(spark, database, table)}
    first, second = (
        comparable(rows).withColumn("sink", F.lit(name)) for name, rows in sinks.items()
    )
    return first.unionAll(second)


def _quarantine(spark: SparkSession, sf_dir: str, state: bool) -> DataFrame:
    rejected = files.BatchTable(spark, scratch(spark, "rejected"), files.reject_schema())
    table = files.BatchTable(spark, scratch(spark, "batches"))
    by_filters = batches.to_unique_table(table, KeyFilters(scratch(spark, "filters")))
    write = batches.to_table(table) if state else by_filters
    _deliver(spark, sf_dir, lambda job: jobs.start_split(spark, job, write, rejected, unique=state))
    texts = [F.col(name).cast("string").alias(name) for name in RAW_COLUMNS if name != "price"]
    stored = table.read(spark).withColumns(
        {"event_time": F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS")}
    )
    parts = [
        rejected.read(spark).select(*texts, "batch_id", "reason"),
        stored.select(*texts, "batch_id", F.lit("stored").alias("reason")),
    ]
    return parts[0].unionAll(parts[1])


@query
def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One pass: valid rows to a table without keys of other batches, rejected rows to another."""
    return _quarantine(spark, sf_dir, state=False)


@query
def stream_unique_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with keys as stream state."""
    return _quarantine(spark, sf_dir, state=True)


@query
def stream_remembered_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys remembered for some days of event time; what comes later goes to a table of its own."""
    table = files.BatchTable(spark, scratch(spark, "batches"))
    late = files.BatchTable(spark, scratch(spark, "late"))
    _deliver(spark, sf_dir, lambda job: jobs.start_remembered(spark, job, table, late, HORIZON))
    first, second = (
        comparable(target.read(spark)).withColumn("fate", F.lit(fate))
        for target, fate in ((table, STORED), (late, LATE))
    )
    return first.unionAll(second)


@query
def stream_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Waves that come while a stream with an interval trigger runs."""
    table = files.BatchTable(spark, scratch(spark, "batches"))
    write = batches.to_unique_table(table, KeyFilters(scratch(spark, "filters")))
    job = jobs.StreamJob(scratch(spark, "incoming"), scratch(spark, "progress"), trigger_seconds=1)
    waves = _waves(spark, sf_dir)
    files.write_event_files(waves[0], job.input_dir)
    query = jobs.start_batches(spark, job, write)
    try:
        for wave in waves[1:]:
            query.processAllAvailable()
            files.write_event_files(wave, job.input_dir)
        query.processAllAvailable()
    finally:
        query.stop()
    return comparable(table.read(spark))


def _summarised(spark: SparkSession, sf_dir: str, unique: bool) -> tuple[DataFrame, DataFrame]:
    """A table filled in waves, and the figures of its batches; the last batch was written twice."""
    table = files.BatchTable(spark, scratch(spark, "batches"))
    parts = files.BatchTable(spark, scratch(spark, "figures"), summaries.SUMMARY_SCHEMA)
    plain = batches.to_table(table)
    write = batches.to_unique_table(table, KeyFilters(scratch(spark, "filters"))) if unique else plain
    write = batches.with_summaries(write, table, parts)
    _deliver(spark, sf_dir, lambda job: jobs.start_batches(spark, job, write))
    last = len(_waves(spark, sf_dir)) - 1
    parts.replace(summaries.summarise(table.read_batches(spark, [last])), last)
    return table.read(spark), parts.read(spark)


@query
def kept_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per action from the figures of the batches; no event is read."""
    return summaries.counts(_summarised(spark, sf_dir, unique=True)[1])


@query
def redelivered_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many keys two deliveries have together and in common, by sketches and exactly."""
    events, parts = _summarised(spark, sf_dir, unique=False)
    found = summaries.compared_keys(summaries.key_sketches(parts))
    keys = events.select("batch_id", "event_id")  # a batch has a key once
    sizes = keys.groupBy("batch_id").agg(F.count(F.lit(1)).alias("size"))
    later = keys.withColumnRenamed("batch_id", "later")
    shared = keys.withColumnRenamed("batch_id", "earlier").join(later, "event_id")
    shared = shared.where("earlier < later").groupBy("earlier", "later").agg(
        F.count(F.lit(1)).alias("shared")
    )
    pairs = found.join(shared, ["earlier", "later"], "left").fillna(0, ["shared"])
    for name in ("earlier", "later"):
        pairs = pairs.join(sizes.toDF(name, f"size_{name}"), name)
    exact = (
        F.when(F.col("measure") == "union", F.expr("size_earlier + size_later - shared"))
        .when(F.col("measure") == "repeated", F.col("shared"))
        .otherwise(F.expr("size_later - shared"))
    )
    near = F.abs(F.col("estimate") - exact) <= F.col("error")
    return pairs.select(
        "earlier", "later", "measure", F.col("estimate").cast("long").alias("estimate"),
        exact.alias("exact"), near.alias("within"),
    )


RANKS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


@query
def price_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices at some ranks from the figures of the batches, and whether they stand there.

    Only the smallest and the largest are the same in every engine.
    """
    events, parts = _summarised(spark, sf_dir, unique=True)
    found = summaries.price_quantiles(parts, RANKS)
    prices = events.select("action", F.col("price").cast("double").alias("value"))
    counted = found.join(prices, "action").groupBy("action", "n", "rank", "price").agg(
        F.count_if(F.col("value") < F.col("price")).alias("below"),
        F.count_if(F.col("value") <= F.col("price")).alias("up_to"),
    )
    n = F.col("n").cast("double")
    near = summaries.rank_is_near(F.col("below"), F.col("up_to"), n, F.col("rank"))
    edge = F.when(F.col("rank").isin(0.0, 1.0), F.col("price"))
    return counted.select("action", "n", "rank", edge.alias("edge"), near.alias("within"))


@query
def metric_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch figures at some ranks from merged sketches; only the rows are the same in every run."""
    metrics = _metrics(spark, sf_dir)
    found = summaries.metric_quantiles(summaries.metric_sketches(metrics, batches_each=2), [0.0, 0.5, 1.0])
    names = ("rows", "seconds", "rows_per_s")
    values = metrics.select(*(F.col(name).cast("double").alias(name) for name in names))
    values = values.unpivot([], list(names), "measure", "one")
    counted = found.join(values, "measure").groupBy("measure", "n", "rank", "value").agg(
        F.count_if(F.col("one") < F.col("value")).alias("below"),
        F.count_if(F.col("one") <= F.col("value")).alias("up_to"),
    )
    n = F.col("n").cast("double")
    near = summaries.rank_is_near(F.col("below"), F.col("up_to"), n, F.col("rank"))
    shown = F.when(F.col("measure") == "rows", F.col("value"))
    return counted.select("measure", "n", "rank", shown.alias("value"), near.alias("within"))


@query
def reject_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change in what batches reject, counted while they are written; one has more bad users."""
    file_no = F.col("file_no")
    planted = (file_no == DAMAGED_FILE) & F.col("event_id").rlike("[02468]$")
    user = F.when(planted, F.concat(F.lit("x"), F.col("user_id"))).otherwise(F.col("user_id"))
    path, reasons = scratch(spark, "rejects"), list(rules())
    counted = RejectLog(path)
    rejected = files.BatchTable(spark, scratch(spark, "rejected"), files.reject_schema())
    write = batches.to_table(files.BatchTable(spark, scratch(spark, "batches")))
    with _stored_feed(spark, sf_dir) as stored:
        feed = stored.withColumn("user_id", user)
        _deliver(
            spark,
            sf_dir,
            lambda job: jobs.start_split(spark, job, write, rejected, counted=counted),
            waves=[feed.where(file_no == number) for number in range(LAST_FILE_OF_SECOND_WAVE + 1)],
        )
    shares = drift.reject_shares(read_reject_counts(spark, path, reasons), reasons)
    found = drift.cusum(shares, "reason", "batch_id", "share", 3, slack=0.01, limit=0.05)
    return found.select(
        "batch_id", "reason", "rejected", F.round("statistic", 6).alias("statistic"), "flagged"
    )


@query
def recorded_triggers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Falling behind by a threshold that one recorded trigger passes.

    The triggers take a second for every ROWS_PER_SECOND rows of their delivery.
    """
    path = scratch(spark, "triggers")
    record = RowLog(path)
    for number, wave in enumerate(_waves(spark, sf_dir)):
        rows = wave.count()
        seconds = rows / ROWS_PER_SECOND
        row = {"input_rows": rows, "trigger_s": seconds, "rows_per_s": rows / seconds if rows else 0.0}
        record.put(spark, number, row)
    triggers = read_triggers(spark, path)
    longest = triggers.agg(F.max("trigger_s")).first()[0]
    late = report.falling_behind(triggers, interval=longest * 0.9)
    return late.select("batch_id", "input_rows", "behind")


@query
def replay_after_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append once, empty the table, and read the same folder again from a new checkpoint."""
    database, table = _database(spark)
    write = batches.append_to(database, table)
    incoming = scratch(spark, "incoming")
    files.write_event_files(raw_feed(spark, sf_dir), incoming)
    for _ in range(2):
        db.empty(spark, database, table)
        job = jobs.StreamJob(incoming, scratch(spark, "progress"), trigger_seconds=None)
        jobs.start_batches(spark, job, write).awaitTermination()
    return comparable(_stored(spark, database, table))


def _metrics(spark: SparkSession, sf_dir: str, empty_wave: bool = False) -> DataFrame:
    path = scratch(spark, "metrics")
    table = files.BatchTable(spark, scratch(spark, "batches"))
    write, metrics = batches.to_table(table), MetricsLog(path)
    _deliver(
        spark, sf_dir, lambda job: jobs.start_batches(spark, job, write, metrics), empty_wave
    )
    return read_metrics(spark, path)


@query
def batch_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per batch. One batch has no valid row: it writes nothing and is noted as skipped."""
    found = _metrics(spark, sf_dir, empty_wave=True)
    timed = (F.col("seconds") > 0) & (F.col("rows_per_s") > 0)
    return found.select("batch_id", "rows", "skipped", timed.alias("timed"))


@query
def trigger_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The triggers that had input, from Spark's progress; none of them took an hour.

    How many rows a trigger read depends on which filters the scan takes, so it is not compared.
    """
    path, name = scratch(spark, "triggers"), f"progress_{uuid.uuid4().hex}"
    table = files.BatchTable(spark, scratch(spark, "batches"))
    listener, write = ProgressLog(spark, path, name), batches.to_table(table)
    spark.streams.addListener(listener)
    try:
        _deliver(spark, sf_dir, lambda job: jobs.start_batches(spark, job, write), name=name)
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(60_000)
    finally:
        spark.streams.removeListener(listener)
    triggers = report.falling_behind(read_triggers(spark, path), interval=3600)
    return triggers.select("batch_id", (F.col("input_rows") > 0).alias("had_input"), "behind")


@query
def days_behind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Falling behind with a threshold that some rows pass: each day's span as a duration."""
    seconds = F.unix_micros("event_time") / 1_000_000
    days = _clean(spark, sf_dir).groupBy(F.to_date("event_time").alias("day")).agg(
        F.count(F.lit(1)).alias("input_rows"), (F.max(seconds) - F.min(seconds)).alias("trigger_s")
    )
    late = report.falling_behind(days, DAY_SECONDS)
    return late.select(F.col("day").cast("string").alias("day"), "input_rows", "behind")


@query
def metrics_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per batch, summarised; the timings differ from run to run and are left out."""
    return report.summarise_batches(_metrics(spark, sf_dir)).where("measure = 'rows'")


@query
def latest_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest by ingest time: rows of the last batch share it, so the key decides."""
    path = scratch(spark, "events")
    _deliver(spark, sf_dir, lambda job: jobs.start_unique_files(spark, job, path))
    newest = report.latest(read_table(spark, path))
    return newest.select("event_id", "action", "product_id", "source")


@query
def stored_at_per_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each batch has one ingest time."""
    table = files.BatchTable(spark, scratch(spark, "batches"))
    write = batches.to_table(table)
    _deliver(spark, sf_dir, lambda job: jobs.start_batches(spark, job, write))
    per_time = table.read(spark).groupBy("batch_id", INGEST_TIME).agg(F.lit(1).alias("one"))
    return per_time.groupBy("batch_id").agg(F.count(INGEST_TIME).alias("times"))
