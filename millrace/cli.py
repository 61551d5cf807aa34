"""Command line: run the streams, reset the target, ask the usual questions."""

from __future__ import annotations

import argparse
import logging
import uuid
from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from millrace.connection import Database, postgres
from millrace.operators import report, summaries
from millrace.operators.clean import clean
from millrace.operators.dedup import one_per_key
from millrace.schema import event_schema
from millrace.session import session
from millrace.sinks import database as db
from millrace.sinks.files import (
    BatchTable,
    reject_schema,
    replay_days,
    write_curve_table,
    write_lookup_table,
)
from millrace.sinks.filters import KeyFilters
from millrace.sources.database import read_database
from millrace.sources.files import read_events, read_table
from millrace.streaming import batches, jobs
from millrace.streaming.metrics import MetricsLog, ProgressLog


def _days(text: str) -> list[date]:
    return [date.fromisoformat(day.strip()) for day in text.split(",")]


# Names of commands and options.
def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="millrace", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    stream = argparse.ArgumentParser(add_help=False)
    stream.add_argument("--input_dir", required=True, help="folder to watch")
    stream.add_argument("--checkpoint_dir", required=True, help="progress, one folder per stream")
    stream.add_argument("--trigger_seconds", type=int, default=5)
    stream.add_argument("--once", action="store_true", help="take what is waiting, then stop")
    bound = stream.add_mutually_exclusive_group()
    bound.add_argument("--max_files", type=int, help="files per batch at most")
    bound.add_argument("--max_bytes", help="bytes per batch at most, such as 64g")
    stream.add_argument("--strict_time", action="store_true", help="times need a date")
    stream.add_argument("--strict_header", action="store_true", help="refuse reordered columns")
    stream.add_argument("--multi_line", action="store_true", help="line breaks within quotes")

    relational = argparse.ArgumentParser(add_help=False)
    # The password comes from PGPASSWORD.
    relational.add_argument("--pg_host", default="localhost")
    relational.add_argument("--pg_port", default="5432")
    relational.add_argument("--pg_db", default="events")
    relational.add_argument("--pg_user")
    relational.add_argument("--pg_table", default="events", help="may name its schema")

    to_database = commands.add_parser("to-database", parents=[stream, relational])
    to_database.add_argument("--on_duplicate", choices=["skip", "fail"], default="skip")
    to_database.add_argument("--metrics_dir", help="keep one row of metrics per batch here")
    to_database.add_argument("--progress_dir", help="keep Spark's figures of each trigger here")
    to_database.add_argument("--connections", type=int, default=db.CONNECTIONS)
    to_database.add_argument("--rejects_dir", help="keep rejected rows and the reason here")

    to_files = commands.add_parser("to-files", parents=[stream])
    to_files.add_argument("--parquet_out", required=True)
    to_files.add_argument("--unique", action="store_true", help="store each key once")
    to_files.add_argument("--state_partitions", type=int, help="fixed by the first start")
    to_files.add_argument("--filters_dir", help="store each key once, by filters kept here")
    to_files.add_argument("--horizon", help="remember keys for so long, such as '20 days'")
    to_files.add_argument("--late_dir", help="where events older than the horizon go")
    to_files.add_argument("--figures_dir", help="keep the figures of each batch here")
    to_files.add_argument("--by_name", action="store_true", help="find columns by header names")
    to_files.add_argument("--console", action="store_true", help="show the rows as well")

    layout = commands.add_parser("layout", help="lay stored events out for lookups")
    layout.add_argument("--parquet_in", required=True)
    layout.add_argument("--parquet_out", required=True)
    layout.add_argument("--curve", action="store_true", help="along a curve, not by day")

    replay = commands.add_parser("replay", help="write days of a table by day anew")
    replay.add_argument("--input_dir", required=True, help="the event files")
    replay.add_argument("--parquet_out", required=True, help="the table")
    replay.add_argument("--days", required=True, type=_days, help="such as 2026-01-05,2026-01-06")

    compact = commands.add_parser("compact", help="merge the folders of old batches")
    compact.add_argument("--parquet_out", required=True)
    compact.add_argument("--before", required=True, type=int, help="first batch that stays")

    figures = commands.add_parser("figures", help="row count and count per action, no event read")
    figures.add_argument("--figures_dir", required=True)

    reset = commands.add_parser("reset", parents=[relational])
    reset.add_argument("--checkpoint_dir", required=True)
    commands.add_parser("check", parents=[relational])
    commands.add_parser("verify", parents=[relational])
    return parser


def _job(args: argparse.Namespace, **extra: str) -> jobs.StreamJob:
    return jobs.StreamJob(
        input_dir=args.input_dir,
        checkpoint_dir=args.checkpoint_dir,
        trigger_seconds=None if args.once else args.trigger_seconds,
        max_files=args.max_files,
        max_bytes=args.max_bytes,
        strict_time=args.strict_time,
        strict_header=args.strict_header,
        multi_line=args.multi_line,
        **extra,
    )


def _database(args: argparse.Namespace) -> Database:
    return postgres(args.pg_host, args.pg_port, args.pg_db, args.pg_user)


def to_database(spark: SparkSession, args: argparse.Namespace, database: Database) -> None:
    """Stream events into the table."""
    db.create_event_table(spark, database, args.pg_table)
    writer = batches.merge_into if args.on_duplicate == "skip" else batches.append_to
    write = writer(database, args.pg_table, args.connections)
    job, metrics = _job(args, name="to-database"), MetricsLog(args.metrics_dir)
    if args.progress_dir:
        spark.streams.addListener(ProgressLog(spark, args.progress_dir, job.name))
    if args.rejects_dir:
        rejected = BatchTable(spark, args.rejects_dir, reject_schema())
        query = jobs.start_split(spark, job, write, rejected, metrics)
    else:
        query = jobs.start_batches(spark, job, write, metrics)
    query.awaitTermination()


def to_files(spark: SparkSession, args: argparse.Namespace) -> None:
    """Stream events into a Parquet folder, and show them if asked to."""
    job = _job(args, ingest_time="processed_at")
    table = BatchTable(spark, args.parquet_out, event_schema(job.ingest_time))
    if args.horizon:
        late = BatchTable(spark, args.late_dir, event_schema(job.ingest_time))
        query = jobs.start_remembered(spark, job, table, late, args.horizon, args.state_partitions)
    elif args.filters_dir or args.figures_dir or args.by_name:
        write = batches.to_table(table)
        if args.filters_dir:
            write = batches.to_unique_table(table, KeyFilters(args.filters_dir))
        if args.figures_dir:
            parts = BatchTable(spark, args.figures_dir, summaries.SUMMARY_SCHEMA)
            write = batches.with_summaries(write, table, parts)
        start = jobs.start_named_batches if args.by_name else jobs.start_batches
        query = start(spark, job, write)
    elif args.unique:
        query = jobs.start_unique_files(
            spark, job, args.parquet_out, args.state_partitions
        )
    else:
        query = jobs.start_files(spark, job, args.parquet_out)
    started = [query]
    if args.console:
        started.append(jobs.start_console(spark, job))
    if args.once:
        for query in started:
            query.awaitTermination()
    else:
        jobs.wait(started)


def layout(spark: SparkSession, args: argparse.Namespace) -> None:
    """Stored events, as files by batch or not, to a table by day or along a curve."""
    events = read_table(spark, args.parquet_in).drop("batch_id")
    write = write_curve_table if args.curve else write_lookup_table
    write(events, args.parquet_out)


def replay(spark: SparkSession, args: argparse.Namespace) -> None:
    """The named days of a table by day, once more from the event files."""
    days = F.to_date("event_time").isin(*map(F.lit, args.days))
    events = one_per_key(clean(read_events(spark, args.input_dir)).where(days))
    replay_days(events, args.parquet_out, args.days)


def figures(spark: SparkSession, args: argparse.Namespace) -> None:
    """How many rows and how many per action, from what the batches left."""
    parts = BatchTable(spark, args.figures_dir, summaries.SUMMARY_SCHEMA).read(spark)
    summaries.total(parts).show()
    summaries.counts(parts).show()


def reset(spark: SparkSession, args: argparse.Namespace, database: Database) -> str:
    """Empty the table and name an unused checkpoint folder for the next run."""
    db.empty(spark, database, args.pg_table)
    fresh = f"{args.checkpoint_dir.rstrip('/')}/{uuid.uuid4().hex}"
    print(f"table emptied; start again with --checkpoint_dir {fresh}")
    return fresh


def check(spark: SparkSession, database: Database) -> None:
    """Read one value through the database."""
    read_database(spark, database, "(SELECT 1 AS ok) t").show()


def verify(spark: SparkSession, args: argparse.Namespace, database: Database) -> None:
    """How many rows, how many per action, and the newest five. The database works them out."""
    table = args.pg_table
    read_database(spark, database, f"(SELECT COUNT(*) AS n FROM {table}) t").show()
    grouped = f"(SELECT action, COUNT(*) AS n FROM {table} GROUP BY action) t"
    read_database(spark, database, grouped).show()
    columns = "event_id, action, product_id, source, stored_at"
    newest = (
        f"(SELECT {columns} FROM {table} ORDER BY stored_at DESC, event_id "
        "FETCH FIRST 5 ROWS ONLY) t"
    )
    report.latest(read_database(spark, database, newest)).show(truncate=False)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = _parser()
    args = parser.parse_args(argv)
    if getattr(args, "horizon", None) and not args.late_dir:
        parser.error("--horizon needs --late_dir, for what comes later")
    logging.basicConfig(level=logging.WARNING, format="%(message)s")
    logging.getLogger("millrace").setLevel(logging.INFO)
    spark = spark or session(f"millrace {args.command}")
    if args.command == "to-files":
        to_files(spark, args)
    elif args.command == "to-database":
        to_database(spark, args, _database(args))
    elif args.command == "layout":
        layout(spark, args)
    elif args.command == "replay":
        replay(spark, args)
    elif args.command == "compact":
        merged = BatchTable(spark, args.parquet_out).compact(spark, args.before)
        print(f"{merged} folders merged")
    elif args.command == "figures":
        figures(spark, args)
    elif args.command == "reset":
        reset(spark, args, _database(args))
    elif args.command == "check":
        check(spark, _database(args))
    else:
        verify(spark, args, _database(args))


if __name__ == "__main__":
    main()
