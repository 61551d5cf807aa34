"""Keys unique over batches: filters of stored batches, and keys remembered for a horizon."""

from __future__ import annotations

from types import SimpleNamespace

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import Row
from pyspark.sql import functions as F

import __spark_entry__ as registered
from conftest import SF
from millrace.sinks import filters
from millrace.sinks.files import BatchTable
from millrace.sinks.filters import KeyFilters
from millrace.streaming import batches, jobs
from millrace.streaming.memory import Remember
from oracle_check import differences, open_oracle


def run(spark, folder, tmp_path, write, **options):
    stream = jobs.StreamJob(folder, str(tmp_path / "progress"), None, max_files=1, **options)
    jobs.start_batches(spark, stream, write).awaitTermination()


def keys(spark, *names):
    return spark.createDataFrame([(name,) for name in names], "event_id string")


def test_filters_name_every_batch_that_holds_a_key(spark, tmp_path):
    held = KeyFilters(str(tmp_path / "filters"))
    sizes = {0: 3, 1: 2000, 2: 40_000}
    for number, size in sizes.items():
        held.add(spark.range(size).select(F.concat_ws("-", F.lit(number), "id").alias("event_id")), number, size)
    assert {row["size"] for row in held.read(spark).select("size").distinct().collect()} == {0, 8, 12}
    asked = spark.range(2000).select("id", F.explode(F.array(*map(F.lit, range(3)))).alias("n"))
    asked = asked.where("n > 0 OR id < 3").select(F.concat_ws("-", "n", "id").alias("event_id"))
    found = KeyFilters(str(tmp_path / "filters")).may_hold(asked).collect()
    yes = {(row.event_id, row.batch_id) for row in found}
    assert {(row.event_id, int(row.event_id[0])) for row in asked.collect()} <= yes
    strange = spark.range(5000).select(F.concat(F.lit("x"), "id").alias("event_id"))
    assert held.may_hold(strange).count() < 0.02 * 3 * 5000


def test_filters_of_single_batches_are_merged(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(filters, "MERGED_FILES", 4)
    held = KeyFilters(str(tmp_path / "filters"))
    assert held.batches_for(keys(spark, "k1"), but=0) == []
    for number in range(11):
        held.add(keys(spark, f"k{number}", "both" if number in (2, 9) else f"z{number}"), number, 2)
    assert len(list((tmp_path / "filters").glob("part-*"))) <= 4
    assert {2, 9} <= set(held.batches_for(keys(spark, "both"), but=0))
    assert 9 not in held.batches_for(keys(spark, "both"), but=9)


def test_a_batch_opens_only_the_folders_whose_filter_answers(spark, put_csv, tmp_path, monkeypatch):
    for number in range(5):
        rows = [{"event_id": f"e{number}-{k}"} for k in range(30)]
        folder = put_csv(f"{number}.csv", *rows, *([{"event_id": "e1-7", "source": "app"}] if number == 4 else []))
    table = BatchTable(spark, str(tmp_path / "table"))
    opened, read = [], table.read_batches

    def noted(session, numbers):
        opened.append(numbers)
        return read(session, numbers)

    monkeypatch.setattr(table, "read_batches", noted)
    write = batches.to_unique_table(table, KeyFilters(str(tmp_path / "filters")))
    run(spark, folder, tmp_path, write)
    # The batch's own folder for its filter; the last one also that of its repeated key.
    assert opened[:4] == [[0], [1], [2], [3]] and opened[-1] == [4] and 1 in opened[-2]
    assert len(opened[-2]) < 4
    found = table.read(spark)
    assert found.count() == 150 and found.where("event_id = 'e1-7'").first().source == "web"


def test_merged_folders_hold_every_batch_once(spark, put_csv, tmp_path):
    for number in range(6):
        folder = put_csv(f"{number}.csv", *({"event_id": f"e{number}-{k}"} for k in range(5)), {"event_id": "again"})
    table = BatchTable(spark, str(tmp_path / "table"))
    write = batches.to_unique_table(table, KeyFilters(str(tmp_path / "filters")))
    run(spark, folder, tmp_path, write)
    before = sorted((r.event_id, r.batch_id) for r in table.read(spark).collect())
    listed = table.read(spark)  # a reader that has listed the folders
    assert table.compact(spark, 3) == 3 and table.compact(spark, 3) == 0
    assert sorted((r.event_id, r.batch_id) for r in table.read(spark).collect()) == before
    assert table.compact(spark, 5) == 2
    again = BatchTable(spark, table.path)
    assert sorted((r.event_id, r.batch_id) for r in again.read(spark).collect()) == before
    assert listed.schema == again.read(spark).schema
    for numbers in ([0], [4, 1], [5], [0, 3, 5]):
        found = sorted(r.event_id for r in again.read_batches(spark, numbers).collect())
        assert found == sorted(name for name, batch in before if batch in numbers)
    names = {p.name for p in (tmp_path / "table").glob("batch_id=*")}
    assert names == {"batch_id=3", "batch_id=4", "batch_id=5"}  # merged ones go with the next call
    put_csv("6.csv", {"event_id": "e0-0"}, {"event_id": "new"})
    run(spark, folder, tmp_path, batches.to_unique_table(again, KeyFilters(str(tmp_path / "filters"))))
    assert sorted(r.event_id for r in again.read(spark).where("batch_id = 6").collect()) == ["new"]


@pytest.mark.parametrize("at", [0, 1, 2])
def test_a_stop_within_a_batch_leaves_each_key_once(spark, put_csv, tmp_path, monkeypatch, at):
    put_csv("1.csv", {"event_id": "a"}, {"event_id": "b"})
    put_csv("2.csv", {"event_id": "b"}, {"event_id": "c"}, {"event_id": "c", "source": "app"})
    folder = put_csv("3.csv", {"event_id": "a"}, {"event_id": "d"})
    table = BatchTable(spark, str(tmp_path / "table"))
    held = KeyFilters(str(tmp_path / "filters"))
    add, calls = held.add, []

    def stopped(rows, number, count):
        if number == at and not calls:
            calls.append(number)
            raise RuntimeError("lost")  # rows are written, their filter is not
        add(rows, number, count)

    monkeypatch.setattr(held, "add", stopped)
    write = batches.to_unique_table(table, held)
    with pytest.raises(StreamingQueryException, match="lost"):
        run(spark, folder, tmp_path, write)
    run(spark, folder, tmp_path, batches.to_unique_table(table, KeyFilters(held.path)))
    rows = sorted((r.event_id, r.batch_id, r.source) for r in table.read(spark).collect())
    assert rows == [("a", 0, "web"), ("b", 0, "web"), ("c", 1, "app"), ("d", 2, "web")]


@pytest.mark.parametrize(
    ("name", "module", "part"),
    [
        ("stream_batch_sink", batches, "one_per_key"),
        ("stream_quarantine", batches, "one_per_key"),
        ("stream_two_sinks", batches, "one_per_key"),
        ("stream_unique_batch_sink", jobs, "first_seen"),
        ("stream_unique_quarantine", jobs, "first_seen"),
    ],
)
def test_checks_of_unique_streams_can_fail(spark, monkeypatch, name, module, part):
    """Without the step that makes rows unique, the query is not what its SQL says."""
    monkeypatch.setattr(module, part, lambda rows: rows)
    sql = registered.oracle_sql()[name]
    try:
        found = registered.queries()[name](spark, SF)
        rows = found.collect()
    except StreamingQueryException:
        return  # a database refuses them outright
    expected = open_oracle(SF).execute(sql)
    columns = [column[0] for column in expected.description]
    assert differences(rows, expected.fetchall(), found.columns, columns)


def test_keys_are_remembered_for_a_horizon(spark, put_csv, tmp_path):
    at = "2026-01-05T10:00:{:02d}".format
    put_csv("1.csv", {"event_id": "a", "event_time": at(10)}, {"event_id": "b", "event_time": at(20)},
            {"event_id": "b", "event_time": at(20), "source": "app"})
    # Known, new, and not late as the newest was 20 and the horizon is 15.
    put_csv("2.csv", {"event_id": "a", "event_time": at(10)}, {"event_id": "c", "event_time": at(50)},
            {"event_id": "d", "event_time": at(6)})
    # Newest 50: all before 35 is late, known or not; copies of c are known.
    folder = put_csv("3.csv", {"event_id": "a", "event_time": at(10)}, {"event_id": "e", "event_time": at(34)},
                     {"event_id": "c", "event_time": at(50)}, {"event_id": "f", "event_time": at(35)})
    stream = jobs.StreamJob(folder, str(tmp_path / "progress"), None, max_files=1)
    table, late = (BatchTable(spark, str(tmp_path / name)) for name in ("table", "late"))
    jobs.start_remembered(spark, stream, table, late, "15 seconds", 2).awaitTermination()
    # Over a restart as well.
    put_csv("4.csv", {"event_id": "f", "event_time": at(35)}, {"event_id": "a", "event_time": at(40)})
    jobs.start_remembered(spark, stream, table, late, "15 seconds", 2).awaitTermination()
    rows = sorted((r.event_id, r.event_time.second, r.source) for r in table.read(spark).collect())
    assert rows == [
        ("a", 10, "web"), ("a", 40, "web"), ("b", 20, "app"), ("c", 50, "web"), ("d", 6, "web"),
        ("f", 35, "web"),
    ]
    assert sorted((r.event_id, r.event_time.second) for r in late.read(spark).collect()) == [("a", 10), ("e", 34)]


class FakeState:
    """One bucket's state and timers, and how often they are asked."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0

    def getValueState(self, name, schema):
        return self

    def exists(self):
        self.calls += 1
        return self.value is not None

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, moment):
        self.calls += 1
        self.timers.add(moment)

    def deleteTimer(self, moment):
        self.calls += 1
        self.timers.remove(moment)


def test_a_bucket_of_keys_is_one_state_with_one_timer():
    state, processor = FakeState(), Remember()
    processor.init(state)

    def batch(watermark, *events):
        times = SimpleNamespace(getCurrentWatermarkInMs=lambda: watermark)
        rows = [Row(event_id=name, millis=moment, _bucket=3) for name, moment in events]
        found = [(r.event_id, r.fate) for r in processor.handleInputRows((3,), iter(rows), times)]
        for fired in sorted(t for t in state.timers if t < watermark):
            info = SimpleNamespace(getExpiryTimeInMs=lambda fired=fired: fired)
            assert not list(processor.handleExpiredTimer((3,), times, info))
            state.timers.discard(fired)
        return found

    many = [(f"e{i}", 100 + i) for i in range(1000)]
    assert batch(0, *many) == [(name, "stored") for name, _ in many]
    assert state.calls <= 4 and state.timers == {101}
    # Known and extended, known, late whether known or not, new.
    assert batch(0, ("e0", 5000), ("e5", 105)) == []
    assert state.timers == {102}
    assert batch(200, ("e1", 101), ("x", 199), ("y", 200)) == [("e1", "late"), ("x", "late"), ("y", "stored")]
    # What is before the watermark is forgotten, at once for the whole bucket.
    assert min(state.value[1]) == 199 and state.timers == {200}
    assert batch(1200, ("e7", 1300), ("e0", 4000)) == [("e7", "stored")]
    assert dict(zip(*state.value, strict=True)) == {"e0": 5000, "e7": 1300}
    assert batch(6000) == [] and state.value is None and not state.timers
