from __future__ import annotations

import uuid
from functools import partial

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from millrace.connection import target
from millrace.operators.clean import clean
from millrace.operators.report import falling_behind
from millrace.schema import RAW_COLUMNS
from millrace.session import settings
from millrace.sinks import database as db
from millrace.sinks.files import BatchTable, reject_schema
from millrace.sources.database import read_database
from millrace.sources.files import read_events, read_table
from millrace.streaming import batches, jobs
from millrace.streaming.metrics import (
    BatchMetric,
    MetricsLog,
    ProgressLog,
    read_metrics,
    read_triggers,
)


@pytest.fixture
def job(tmp_path):
    def make(folder: str, run: str = "first", **options) -> jobs.StreamJob:
        options = {"trigger_seconds": None, **options}
        return jobs.StreamJob(folder, str(tmp_path / f"progress-{run}"), **options)

    return make


@pytest.fixture
def store(spark):
    table = f"s_{uuid.uuid4().hex[:12]}"
    database = target(spark, table)
    db.create_event_table(spark, database, table)
    return database, table


def ids(frame) -> list[str]:
    return sorted(row.event_id for row in frame.collect())


def drain(spark, job, write, metrics=None):
    query = jobs.start_batches(spark, job, write, metrics)
    query.awaitTermination()
    return query


def failing_once(write, at: int):
    """Fails a batch after its rows are written and before it is committed."""
    failed = []

    def wrapped(rows, batch_id):
        count = write(rows, batch_id)
        if batch_id.number == at and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost")
        return count

    return wrapped


def test_stream_equals_batch(spark, put_csv, job, tmp_path):
    put_csv("1.csv", {"event_id": "a"}, {"event_id": "a"}, {"action": "click"})
    folder = put_csv("2.csv", {"event_id": "b", "price": "1.005"}, {"event_time": "?"})
    out = str(tmp_path / "out")
    jobs.start_files(spark, job(folder), out).awaitTermination()
    stored = read_table(spark, out).drop("stored_at")
    expected = clean(read_events(spark, folder)).drop("stored_at")
    assert stored.exceptAll(expected).count() == expected.exceptAll(stored).count() == 0
    assert ids(stored) == ["a", "a", "b"]


def test_each_file_is_read_once_per_checkpoint(spark, put_csv, job, tmp_path):
    folder = put_csv("1.csv", {"event_id": "a"})
    out = str(tmp_path / "out")
    for name in ("b", "c"):
        jobs.start_files(spark, job(folder), out).awaitTermination()
        put_csv(f"{name}.csv", {"event_id": name})
    jobs.start_files(spark, job(folder), out).awaitTermination()
    assert ids(read_table(spark, out)) == ["a", "b", "c"]


def test_batches_are_bounded(spark, put_csv, job, tmp_path):
    for n in range(5):
        folder = put_csv(f"{n}.csv", {"event_id": f"e{n}"}, {"event_id": f"e{n}"})
    path = str(tmp_path / "metrics")
    table = BatchTable(spark, str(tmp_path / "table"))
    query = drain(spark, job(folder, max_files=2), batches.to_table(table), MetricsLog(path))
    recorded = read_metrics(spark, path)
    assert sorted(row.rows for row in recorded.collect()) == [1, 2, 2]
    per_batch = table.read(spark).groupBy("batch_id").agg(F.count_distinct("stored_at").alias("n"))
    assert {row.n for row in per_batch.collect()} == {1}
    assert recorded.where("seconds > 0 AND rows_per_s > 0").count() == 3
    assert len(list((tmp_path / "metrics").glob("*.json"))) == 1
    assert query.exception() is None


def test_progress_of_every_trigger_is_kept(spark, put_csv, job, tmp_path):
    for n in range(4):
        folder = put_csv(f"{n}.csv", {"event_id": f"e{n}"}, {"action": "click"})
    path, named = str(tmp_path / "triggers"), f"p{uuid.uuid4().hex}"
    listener = ProgressLog(spark, path, named)
    spark.streams.addListener(listener)
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    table = BatchTable(spark, str(tmp_path / "table"))
    try:
        drain(spark, job(folder, max_files=1, name=named), batches.to_table(table))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)
        spark.streams.removeListener(listener)
    found = read_triggers(spark, path)
    assert sorted(tuple(row) for row in found.select("batch_id", "input_rows").collect()) == [
        (n, 2) for n in range(4)
    ]
    assert falling_behind(found, 0).where("behind").count() == 4
    assert falling_behind(found, 3600).where("behind").count() == 0


def test_a_replayed_row_replaces_its_own(spark, tmp_path):
    path = str(tmp_path / "metrics")
    MetricsLog(path).add(spark, 0, BatchMetric(7, 1.0))
    again = MetricsLog(path)  # after a restart
    again.add(spark, 1, BatchMetric(0, 0.0, skipped=True))
    again.add(spark, 0, BatchMetric(9, 2.0))
    again.add(spark, 1000, BatchMetric(1, 1.0))
    rows = sorted(tuple(row) for row in read_metrics(spark, path).collect())
    assert rows == [(0, 9, 2.0, 4.5, False), (1, 0, 0.0, 0.0, True), (1000, 1, 1.0, 1.0, False)]


def test_small_batch_is_one_file(spark, put_csv, job, tmp_path):
    folder = put_csv("1.csv", *({"event_id": f"e{n}"} for n in range(50)))
    table = BatchTable(spark, str(tmp_path / "table"))
    drain(spark, job(folder), batches.to_table(table))
    assert len(list((tmp_path / "table" / "batch_id=0").glob("*.parquet"))) == 1


def test_batch_without_valid_rows_writes_nothing(spark, put_csv, job, tmp_path, caplog):
    folder = put_csv("1.csv", {"action": "click"})
    table = BatchTable(spark, str(tmp_path / "table"))
    with caplog.at_level("INFO", logger="millrace"):
        drain(spark, job(folder), batches.to_table(table))
    assert "batch 0: 0 rows (skipped)" in caplog.messages
    assert not (tmp_path / "table" / "batch_id=0").exists()


def test_rejected_rows_are_kept_with_their_reason(spark, put_csv, job, tmp_path):
    put_csv("1.csv", {"event_id": "a"}, {"action": "click", "price": "?"}, {"user_id": "x"})
    folder = put_csv("2.csv", {"event_time": "12"}, {"event_id": "b"}, {"event_id": "b"})
    rejected = BatchTable(spark, str(tmp_path / "rejected"), reject_schema())
    table = BatchTable(spark, str(tmp_path / "table"))
    write = failing_once(batches.to_table(table), at=1)
    stream = job(folder, max_files=1)
    with pytest.raises(StreamingQueryException, match="lost"):
        jobs.start_split(spark, stream, write, rejected).awaitTermination()
    jobs.start_split(spark, stream, write, rejected).awaitTermination()
    assert ids(table.read(spark)) == ["a", "b"]
    found = {row.reason: row for row in rejected.read(spark).collect()}
    assert set(found) == {"bad_action", "bad_user_id", "bad_event_time"}
    assert found["bad_action"].price == "?" and found["bad_action"].stored_at is not None
    per_batch = table.read(spark).select("batch_id", "stored_at")
    stamps = rejected.read(spark).select("batch_id", "stored_at").unionAll(per_batch)
    assert stamps.distinct().count() == 2


def test_split_keeps_keys_unique_over_batches(spark, put_csv, job, tmp_path):
    put_csv("1.csv", {"event_id": "a"}, {"event_id": "c", "action": "click"}, {"event_id": "b"})
    put_csv("2.csv", {"event_id": "a", "source": "app"}, {"event_id": "c", "action": "click"})
    folder = put_csv("3.csv", {"event_id": "b"}, {"event_id": "c"}, {"event_id": None})
    rejected = BatchTable(spark, str(tmp_path / "rejected"), reject_schema())
    table = BatchTable(spark, str(tmp_path / "table"))
    write = failing_once(batches.to_table(table), at=2)
    stream = job(folder, max_files=1)
    start = partial(jobs.start_split, spark, stream, write, rejected, unique=True)
    with pytest.raises(StreamingQueryException, match="lost"):
        start(state_partitions=2).awaitTermination()
    start(state_partitions=2).awaitTermination()
    rows = sorted((r.event_id, r.batch_id) for r in table.read(spark).collect())
    assert rows == [("a", 0), ("b", 0), ("c", 2)]
    broken = sorted((r.batch_id, r.reason) for r in rejected.read(spark).collect())
    assert broken == [(0, "bad_action"), (1, "bad_action"), (2, "missing_event_id")]


def test_bytes_bound_a_batch(spark, put_csv, job, tmp_path):
    for n in range(4):
        folder = put_csv(f"{n}.csv", {"event_id": f"e{n}"})
    query = drain(spark, job(folder, max_bytes="1"), lambda rows, batch_id: rows.count())
    assert len([batch for batch in query.recentProgress if batch.numInputRows]) == 4


def test_metric_line(caplog, spark):
    with caplog.at_level("INFO", logger="millrace"):
        MetricsLog().add(spark, 3, BatchMetric(124, 0.2))
    assert caplog.messages == ["batch 3: 124 rows | 0.20s | 620.0 rows/s"]
    assert BatchMetric(5, 0.0).rows_per_s == 5.0


@pytest.mark.parametrize("kind", ["files", "database"])
def test_replayed_batch_leaves_its_rows_once(spark, put_csv, job, store, tmp_path, kind):
    put_csv("1.csv", {"event_id": "a"}, {"event_id": "b"})
    put_csv("2.csv", {"event_id": "b"}, {"event_id": "c"}, {"event_id": "c"})
    folder = put_csv("3.csv", {"event_id": "a"}, {"event_id": "d"})
    if kind == "files":
        table = BatchTable(spark, str(tmp_path / "table"))
        write, read = batches.to_table(table), lambda: table.read(spark)
    else:
        write, read = batches.merge_into(*store), lambda: read_database(spark, *store)
    write, stream = failing_once(write, at=1), job(folder, max_files=1)

    def run():
        start = jobs.start_batches(spark, stream, write, unique=kind == "files")
        start.awaitTermination()

    with pytest.raises(StreamingQueryException, match="lost"):
        run()
    run()
    assert ids(read()) == ["a", "b", "c", "d"]


def test_first_delivery_wins_over_batches(spark, put_csv, job, store, tmp_path):
    put_csv("1.csv", {"event_id": "a", "source": "web"})
    folder = put_csv("2.csv", {"event_id": "a", "source": "app"}, {"event_id": "b"})
    table = BatchTable(spark, str(tmp_path / "table"))
    jobs.start_batches(
        spark, job(folder, "files", max_files=1), batches.to_table(table), unique=True
    ).awaitTermination()
    drain(spark, job(folder, "database", max_files=1), batches.merge_into(*store))
    for rows in (table.read(spark), read_database(spark, *store)):
        found = {row.event_id: row.source for row in rows.collect()}
        assert set(found) == {"a", "b"} and found["a"] in ("web", "app")
    assert {r.source for r in table.read(spark).where("event_id = 'a'").collect()} == {
        r.source for r in read_database(spark, *store).where("event_id = 'a'").collect()
    }


def test_append_fails_on_a_key_of_an_earlier_batch(spark, put_csv, job, store):
    put_csv("1.csv", {"event_id": "a"}, {"event_id": "a"})
    folder = put_csv("2.csv", {"event_id": "a"})
    stream = job(folder, max_files=1)
    with pytest.raises(StreamingQueryException, match="duplicate key"):
        drain(spark, stream, batches.append_to(*store))
    assert ids(read_database(spark, *store)) == ["a"]


def test_clean_rerun(spark, put_csv, job, store):
    folder = put_csv("1.csv", {"event_id": "a"}, {"event_id": "b"})
    for run in ("one", "two"):
        db.empty(spark, *store)
        assert read_database(spark, *store).count() == 0
        drain(spark, job(folder, run), batches.append_to(*store))
        assert ids(read_database(spark, *store)) == ["a", "b"]


def test_state_remembers_keys_over_restarts(spark, put_csv, job, tmp_path):
    out = str(tmp_path / "out")
    folder = put_csv("1.csv", *[{"event_id": "hot"}] * 300, {"event_id": "a"})
    start = partial(jobs.start_unique_files, spark, state_partitions=2)
    start(job(folder), out).awaitTermination()
    put_csv("2.csv", *[{"event_id": "hot"}] * 300, {"event_id": "b"})
    start(job(folder), out).awaitTermination()
    assert ids(read_table(spark, out)) == ["a", "b", "hot"]
    assert len(list((tmp_path / "progress-first" / "state" / "0").glob("[0-9]*"))) == 2
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_thinning_drops_copies_before_the_shuffle(spark, raw):
    """Whatever the size of batches between Spark and Python."""
    events = clean(raw(*[{"event_id": "hot"}] * 500, {"event_id": "a"})).coalesce(1)
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "7"}):
        assert ids(events.mapInArrow(jobs._thin, events.schema)) == ["a", "hot"]


def test_thinning_holds_a_bounded_number_of_bytes(spark, raw):
    sources = ["b", "a", "c"]
    changes = [{"event_id": f"e{n % 40}", "source": sources[n % 3]} for n in range(400)]
    events = clean(raw(*changes)).select("event_id", "source")
    small = [events.toArrow().slice(n, 20).combine_chunks() for n in range(0, 400, 20)]
    parts = [batch for part in small for batch in part.to_batches()]
    handed = list(jobs._thin(iter(parts), held_bytes=600))
    assert sum(len(batch) for batch in handed) > 40 and len(handed) > 2  # most were handed on
    whole = list(jobs._one_each(iter(parts)))
    rows = sorted((r["event_id"], r["source"]) for batch in whole for r in batch.to_pylist())
    assert rows == sorted((f"e{n}", "a") for n in range(40))


def test_the_smallest_copy_of_a_batch_stays(spark, put_csv, job, tmp_path):
    """As one_per_key has it, missing values first."""
    put_csv("1.csv", {"event_id": "a", "source": "web"}, {"event_id": "a", "source": "app"})
    folder = put_csv(
        "2.csv",
        {"event_id": "a", "source": "aaa"},
        {"event_id": "b", "price": "10.00"},
        {"event_id": "b", "price": "9.00"},
        {"event_id": "c", "price": "1.00"},
        {"event_id": "c", "price": None},
    )
    out = str(tmp_path / "out")
    jobs.start_unique_files(spark, job(folder, max_files=1), out).awaitTermination()
    found = {r.event_id: (r.source, r.price and float(r.price)) for r in read_table(spark, out).collect()}
    assert found == {"a": ("app", None), "b": ("web", 9.0), "c": ("web", None)}


def test_late_first_deliveries_are_kept(spark, put_csv, job, tmp_path):
    """No event is ever late: an older time in a later file is as good as any."""
    for n, at in enumerate(("2026-03-01", "2026-01-01", "2025-06-01", "2026-03-02")):
        folder = put_csv(f"{n}.csv", {"event_id": f"e{n}", "event_time": at})
    out = str(tmp_path / "out")
    jobs.start_unique_files(spark, job(folder, max_files=1), out).awaitTermination()
    assert ids(read_table(spark, out)) == ["e0", "e1", "e2", "e3"]


def test_unique_stream_writes_one_file_per_small_batch(spark, put_csv, job, tmp_path):
    out = tmp_path / "out"
    for n in range(3):
        rows = [{"event_id": f"e{n}-{k}"} for k in range(125)] + [{"event_id": "again"}]
        folder = put_csv(f"{n}.csv", *rows)
    jobs.start_unique_files(spark, job(folder, max_files=1), str(out)).awaitTermination()
    assert [len(list((out / f"batch_id={n}").glob("*.parquet"))) for n in range(3)] == [1, 1, 1]
    assert read_table(spark, str(out)).count() == 376


@pytest.mark.parametrize("kind", ["merge", "append"])
def test_replay_counts_what_the_batch_added(spark, put_csv, job, store, tmp_path, kind):
    """Stopped between move and commit: nothing is lost, stuck or counted as nothing."""
    put_csv("1.csv", {"event_id": "a"}, {"event_id": "b"})
    folder = put_csv("2.csv", {"event_id": "c"}, {"event_id": "d"}, {"event_id": "e"})
    path = str(tmp_path / "metrics")
    write = {"merge": batches.merge_into, "append": batches.append_to}[kind](*store)
    stream = job(folder, max_files=1)
    with pytest.raises(StreamingQueryException, match="lost"):
        drain(spark, stream, failing_once(write, at=1), MetricsLog(path))
    drain(spark, stream, write, MetricsLog(path))
    assert ids(read_database(spark, *store)) == ["a", "b", "c", "d", "e"]
    counts = {row.batch_id: row.rows for row in read_metrics(spark, path).collect()}
    assert sum(counts.values()) == 5 and len(counts) == 2


def test_two_targets_from_one_pass(spark, put_csv, job, store, tmp_path):
    put_csv("1.csv", {"event_id": "a"}, {"event_id": "b"})
    folder = put_csv("2.csv", {"event_id": "b"})
    table = BatchTable(spark, str(tmp_path / "table"))
    write = batches.to_all(
        batches.to_table(table), batches.merge_into(*store)
    )
    query = drain(spark, job(folder, max_files=1), write)
    assert ids(table.read(spark)) == ["a", "b", "b"]
    assert ids(read_database(spark, *store)) == ["a", "b"]
    assert query.exception() is None


def test_console_keeps_no_progress(spark, put_csv, job, tmp_path):
    folder = put_csv("1.csv", {"event_id": "shown"})
    for _ in range(2):
        query = jobs.start_console(spark, job(folder))
        query.awaitTermination()
        assert sum(batch.numInputRows for batch in query.recentProgress) == 1
    assert not (tmp_path / "progress-first").exists()


def test_interval_trigger(spark, put_csv, job, tmp_path):
    folder = put_csv("1.csv", {"event_id": "a"})
    out = str(tmp_path / "out")
    query = jobs.start_files(spark, job(folder, trigger_seconds=1), out)
    try:
        query.processAllAvailable()
        put_csv("2.csv", {"event_id": "b"})
        query.processAllAvailable()
        assert ids(read_table(spark, out)) == ["a", "b"]
    finally:
        query.stop()


def test_wait_raises_when_a_query_fails(spark, put_csv, job):
    spark.streams.resetTerminated()
    folder = put_csv("1.csv", {"event_id": "a"})

    def fail(rows, batch_id):
        raise RuntimeError("broken target")

    other = jobs.start_console(spark, job(put_csv("1.csv", {}), trigger_seconds=60))
    query = jobs.start_batches(spark, job(folder), fail, unique=True)
    try:
        with pytest.raises(StreamingQueryException, match="broken target"):
            jobs.wait([other, query])
    finally:
        other.stop()
    spark.streams.resetTerminated()


def test_strict_header_fails_the_stream(spark, put_csv, job, tmp_path):
    swapped = (RAW_COLUMNS[1], RAW_COLUMNS[0], *RAW_COLUMNS[2:])
    folder = put_csv("1.csv", {}, header=swapped)
    query = jobs.start_files(spark, job(folder, strict_header=True), str(tmp_path / "out"))
    with pytest.raises(StreamingQueryException):
        query.awaitTermination()
