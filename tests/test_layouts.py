"""Layout along a curve, days written anew, files read by name."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date, datetime
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import GOOD
from millrace.functions.rules import is_valid
from millrace.operators.report import in_time_range
from millrace.schema import DAY, RAW_COLUMNS
from millrace.sinks import files
from millrace.sources.by_name import named_events, read_events_by_name, split_fields, watch_lines
from millrace.sources.files import QUOTING


@pytest.fixture(scope="module")
def events(spark):
    """24,000 events of 300 users and 200 products over 30 days, one user and product hot."""
    number = F.col("id")
    user = F.when(number % 5 == 0, 1).otherwise(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(300)))
    product = F.when(number % 7 == 0, 1).otherwise(F.pmod(F.xxhash64("id", F.lit(2)), F.lit(200)))
    second = F.pmod(F.xxhash64("id", F.lit(3)), F.lit(30 * 86_400))
    return spark.range(24_000).select(
        F.concat(F.lit("e"), "id").alias("event_id"),
        F.timestamp_seconds(F.lit(1_704_067_200) + second).alias("event_time"),
        F.current_timestamp().alias("stored_at"),
        user.cast("int").alias("user_id"),
        F.lit("view").alias("action"),
        product.cast("int").alias("product_id"),
        F.lit("web").alias("source"),
    )


def groups(path, column):
    """Smallest and largest value of a column in every row group."""
    found = []
    for name in Path(path).rglob("*.parquet"):
        meta = pq.ParquetFile(name).metadata
        place = meta.schema.names.index(column)
        stats = [meta.row_group(g).column(place).statistics for g in range(meta.num_row_groups)]
        found += [(s.min, s.max) for s in stats]
    return found


def touched(path, column, value):
    found = groups(path, column)
    return sum(low <= value <= high for low, high in found) / len(found)


def test_curve_serves_every_lookup(spark, events, tmp_path):
    curve, days = str(tmp_path / "curve"), str(tmp_path / "days")
    files.write_curve_table(events, curve, group_rows=200)
    files.write_lookup_table(events, days)
    assert spark.read.parquet(curve).count() == 24_000
    assert len(groups(curve, "user_id")) >= 100
    # A user, a product and an hour each touch a part of the groups; by day only a time does.
    for column, value in (("user_id", 150), ("product_id", 90)):
        assert touched(curve, column, value) < 0.4
        assert touched(days, column, value) > 0.9
    start, end = datetime(2024, 1, 15, 12), datetime(2024, 1, 15, 13)
    assert touched(curve, "event_micros", 1_705_320_000_000_000) < 0.4
    found = in_time_range(spark.read.parquet(curve), start, end)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(event_micros,1705320000000000)" in plan
    assert found.count() == in_time_range(events, start, end).count() > 0


def test_curve_ranks(spark):
    """Places deal out the bits of ranks; one value and missing values are no trouble."""
    rows = [(f"e{i}", i % 4, 5, datetime(2024, 1, 1 + i // 4)) for i in range(16)] + [("n", None, 5, None)]
    frame = spark.createDataFrame(rows, "event_id string, user_id int, product_id int, event_time timestamp")
    found = frame.withColumn("place", files.curve_place(frame, ("user_id", "event_time"), bits=2)).collect()
    spread = lambda x: (x & 1) | (x & 2) << 1
    expected = {f"e{i}": spread(i % 4) | spread(i // 4) << 1 for i in range(16)} | {"n": 0}
    assert {r.event_id: r.place for r in found} == expected
    alike = frame.withColumn("place", files.curve_place(frame, ("product_id",), bits=3))
    assert len({r.place for r in alike.collect()}) == 1
    none = frame.limit(0)
    assert none.withColumn("place", files.curve_place(none, ("user_id",))).collect() == []


def names_by_day(path):
    return {p.name: sorted(f.name for f in p.glob("*.parquet")) for p in Path(path).glob(f"{DAY}=*")}


def test_only_named_days_are_written_anew(spark, events, tmp_path):
    path = str(tmp_path / "days")
    days = (date(2024, 1, 3), date(2024, 1, 9), date(2024, 2, 20))
    damaged = events.where(F.to_date("event_time") != F.lit(days[0]))
    extra = events.limit(1).withColumn("event_time", F.lit(datetime(2024, 2, 20, 1)))
    files.write_lookup_table(damaged.unionAll(extra), path)
    before = names_by_day(path)
    files.replay_days(events, path, days)
    after = names_by_day(path)
    changed = {f"{DAY}={day}" for day in days}
    assert {d: f for d, f in before.items() if d not in changed} == {d: f for d, f in after.items() if d not in changed}
    assert before["event_date=2024-01-09"] != after["event_date=2024-01-09"]
    assert "event_date=2024-02-20" not in after
    columns = events.columns
    stored = spark.read.parquet(path).select(*columns).drop("stored_at")
    assert stored.exceptAll(events.drop("stored_at")).isEmpty() and stored.count() == 24_000


def put(folder: Path, name: str, header: list[str], *rows: dict) -> None:
    lines = [",".join(header)]
    lines += [",".join((GOOD | row).get(column.strip()) or "" for column in header) for row in rows]
    (folder / name).write_text("\n".join(lines) + "\n")


@pytest.fixture
def mixed(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    put(folder, "a.csv", list(RAW_COLUMNS), {"event_id": "a"}, {"event_id": "b", "source": None})
    put(folder, "b.csv", [*reversed(RAW_COLUMNS), "app"], {"event_id": "c", "app": "v2"}, {"event_id": "d"})
    put(folder, "c.csv", ["event_id", "action", " user_id", "product_id", "event_time"], {"event_id": "e"})
    (folder / "d.csv").write_text("f,2026-01-05,1,view,2\n")  # no header
    with (folder / "c.csv").open("a") as file:
        file.write("wide,view,1,2,2026-01-05,more\nshort,view\n")
    (folder / "e.csv").write_text("")
    return str(folder)


def test_columns_are_found_by_name(spark, mixed):
    rows = {r.event_id: r for r in read_events_by_name(spark, mixed).where("malformed IS NULL").collect()}
    assert set(rows) == {"a", "b", "c", "d", "e", "short"}
    for name in RAW_COLUMNS[1:-3]:
        assert rows["a"][name] == rows["c"][name] == GOOD[name]
    assert rows["e"].product_name is None and rows["e"].user_id == "1" and rows["b"].source is None
    assert rows["c"].others == {"app": "v2"} and rows["d"].others == {"app": None} and rows["a"].others == {}
    assert rows["short"].user_id is None
    bad = sorted(r.malformed for r in read_events_by_name(spark, mixed).where("malformed IS NOT NULL").collect())
    assert bad == ["f,2026-01-05,1,view,2", "wide,view,1,2,2026-01-05,more"]


def test_stream_by_name_equals_batch(spark, mixed, tmp_path):
    out = str(tmp_path / "out")

    def handle(batch, batch_id):
        named_events(batch).drop("others").write.mode("overwrite").parquet(f"{out}/b={batch_id}")

    writer = watch_lines(spark, mixed, max_files=2).writeStream.foreachBatch(handle)
    writer = writer.option("checkpointLocation", str(tmp_path / "progress")).trigger(availableNow=True)
    writer.start().awaitTermination()
    whole = read_events_by_name(spark, mixed).drop("others")
    found = spark.read.parquet(out).drop("b")
    assert found.exceptAll(whole).isEmpty() and whole.exceptAll(found).isEmpty()
    assert whole.where(is_valid(columns=whole.columns)).count() == 5


def test_lines_are_split_as_the_csv_reader_does(spark, tmp_path):
    rng = random.Random(7)
    lines = ["".join(rng.choices('ab,"\\ \'#é', [4, 4, 6, 3, 1, 2, 1, 1, 1], k=rng.randrange(1, 24))) for _ in range(3000)]
    lines += ["".join(rng.choices('a,"', [2, 9, 1], k=rng.randrange(40, 160))) for _ in range(300)]
    lines += ['"a,""b""",c', 'a"b,"c', '"open,a', " ", "\t", ",,,", "x" * 5000, ",".join(map(str, range(70)))]
    path = tmp_path / "lines.csv"
    path.write_text("\n".join(lines) + "\n")
    names = [f"field_{i}" for i in range(64)]
    schema = ", ".join(f"{name} string" for name in names)
    parsed = spark.read.schema(schema).options(**QUOTING, mode="PERMISSIVE").csv(str(path))
    expected = Counter(tuple(row) for row in parsed.collect())
    text = spark.read.text(str(path)).where(F.col("value").rlike(r"[^\x00-\x20]"))
    found = text.select(split_fields(F.col("value")).alias("fields")).collect()
    assert Counter((*r.fields, *[None] * (64 - len(r.fields))) for r in found) == expected


def test_files_by_name_are_parsed_without_missing_fields(spark, mixed):
    """The plan holds no scan of CSV, whose parser fails once for each column a line lacks."""
    rows = read_events_by_name(spark, mixed)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Scan csv" not in plan and "FileScan csv" not in plan and "BroadcastHashJoin" in plan
