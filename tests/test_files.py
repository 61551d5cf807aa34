from __future__ import annotations

import csv
import re
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import GOOD, SF
from millrace.operators.clean import clean, rejects
from millrace.operators.report import in_time_range
from millrace.schema import RAW_COLUMNS, event_schema
from millrace.session import scratch, settings
from millrace.sinks import files
from millrace.sources.feed import raw_feed
from millrace.sources.files import read_events, read_table


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_only_finished_files_are_read(spark, put_csv):
    put_csv("events_1.csv", {"event_id": "a"})
    folder = put_csv("events_2.tmp", {"event_id": "a"})
    assert read_events(spark, folder).count() == 1


def test_empty_fields_and_short_rows_are_null(spark, put_csv):
    folder = Path(put_csv("a.csv", {"event_id": "", "price": ""}))
    (folder / "b.csv").write_text(",".join(RAW_COLUMNS) + '\nb,2026-01-05,1,view,2,"Oil, 1L"\n')
    rows = {r.product_name: r for r in read_events(spark, str(folder)).collect()}
    assert rows["Teapot (blue)"].event_id is None and rows["Teapot (blue)"].price is None
    assert rows["Oil, 1L"].source is None and rows["Oil, 1L"].malformed is not None


def test_lines_of_the_wrong_width_are_rejected(spark, put_csv):
    folder = Path(put_csv("a.csv", {"event_id": "good"}))
    line = "short,2026-01-05,1,view,2"
    (folder / "b.csv").write_text(f"{','.join(RAW_COLUMNS)}\n{line}\n{line},a,b,,,web,more\n")
    raw = read_events(spark, str(folder))
    assert [row.event_id for row in clean(raw).collect()] == ["good"]
    bad = rejects(raw).collect()
    assert {row.reason for row in bad} == {"bad_width"}
    assert sorted(row.malformed for row in bad) == sorted([line, f"{line},a,b,,,web,more"])


def test_quoted_text_as_other_writers_quote_it(spark, tmp_path):
    names = ['Monitor 27", black', 'say ""', '"', "a,b", "tab\tand 'quote'", 'end"']
    folder = tmp_path / "in"
    folder.mkdir()
    with (folder / "a.csv").open("w", newline="") as file:
        writer = csv.DictWriter(file, RAW_COLUMNS)
        writer.writeheader()
        for n, name in enumerate(names):
            writer.writerow({**GOOD, "event_id": f"e{n}", "product_name": name})
    raw = read_events(spark, str(folder))
    assert [row.product_name for row in raw.orderBy("event_id").collect()] == names
    assert clean(raw).count() == len(names)
    files.write_event_files(raw, str(tmp_path / "again"))
    again = read_events(spark, str(tmp_path / "again"))
    assert [row.product_name for row in again.orderBy("event_id").collect()] == names


def test_line_breaks_within_quotes(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    with (folder / "a.csv").open("w", newline="") as file:
        writer = csv.DictWriter(file, RAW_COLUMNS)
        writer.writeheader()
        writer.writerow({**GOOD, "product_name": "two\nlines"})
    found = read_events(spark, str(folder), multi_line=True).collect()
    assert [row.product_name for row in found] == ["two\nlines"]
    assert clean(read_events(spark, str(folder))).count() == 0


def test_reordered_header(spark, put_csv):
    swapped = (RAW_COLUMNS[1], RAW_COLUMNS[0], *RAW_COLUMNS[2:])
    folder = put_csv("a.csv", {}, header=swapped)
    assert read_events(spark, folder).first()["event_time"] == "a"  # by position
    with pytest.raises(Exception, match="header does not conform"):
        read_events(spark, folder, strict_header=True).collect()


def test_arrivals_have_headers_and_keep_every_row(spark, tmp_path):
    feed, path = raw_feed(spark, SF), str(tmp_path / "arrivals")
    files.write_arrivals(feed, path)
    written = list(Path(path).rglob("*.csv"))
    assert len({file.parent.name for file in written}) == 9
    assert all(file.read_text().startswith(",".join(RAW_COLUMNS)) for file in written)
    back = read_events(spark, path)
    assert {row.malformed for row in back.collect()} == {None}
    assert back.drop("malformed").exceptAll(feed.drop("file_no")).count() == 0
    assert back.count() == feed.count()


def test_scan_takes_filters_and_columns(spark, put_csv):
    folder = put_csv("a.csv", {})
    counts = clean(read_events(spark, folder)).groupBy("action").count()
    text = plan(counts)
    pushed = re.search(r"PushedFilters: (.*?), ReadSchema", text).group(1)
    assert "In(action" in pushed and "IsNotNull(event_id)" in pushed
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "price" not in schema and "source" not in schema


def test_lookup_table_prunes(spark, tmp_path):
    path = str(tmp_path / "lookup")
    files.write_lookup_table(clean(raw_feed(spark, SF)), path)
    events = read_table(spark, path)
    day = events.select(F.min(files.DAY)).first()[0]
    text = plan(events.where(F.col(files.DAY) == day).where("user_id = 12 AND product_id = 7"))
    assert re.search(r"PartitionFilters: \[[^\]]*event_date", text)
    assert "EqualTo(user_id,12)" in text and "EqualTo(product_id,7)" in text
    text = plan(in_time_range(events, datetime(2024, 1, 5), datetime(2024, 1, 6)))
    found = re.search(r"PartitionFilters: \[([^\]]*)\]", text).group(1)
    assert "event_date" in found and "2024-01-05" in found and "2024-01-06" in found


def test_create_twice_keeps_rows(spark, raw, tmp_path):
    name, path = "made_twice", str(tmp_path / "table")
    files.create_event_table(spark, name, path)
    files.append_to_table(clean(raw({})), name)
    files.create_event_table(spark, name, path)
    assert spark.table(name).count() == 1
    assert spark.table(name).schema.names == event_schema().names
    spark.sql(f"DROP TABLE {name}")


def test_batch_table_replaces_a_batch(spark, raw, tmp_path):
    table = files.BatchTable(spark, str(tmp_path / "batches"))
    assert table.read(spark).count() == 0
    events = clean(raw({"event_id": "a"}, {"event_id": "b"}))
    for batch_id in (0, 1, 1):
        table.replace(events, batch_id)
    assert table.read(spark).count() == 4
    again = files.BatchTable(spark, table.path)
    assert again.read(spark).count() == 4


def test_scratch_uses_the_named_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch(spark, "x"), scratch(spark, "x")
    assert spark.sparkContext.master.startswith("local[")
    assert first != second
    if base:
        assert first.startswith(base.rstrip("/"))


def test_hot_product_is_split_when_the_join_shuffles(spark, tmp_path):
    """Products too large to broadcast, and a third of the events on one of them."""
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000)
    events = spark.range(100_000, numPartitions=8).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(F.col("id") + 1_700_000_000).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 50).alias("user_id"),
        F.lit("view").alias("event_type"),
        F.lit(1.5).alias("value"),
        F.to_json(F.struct(key.alias("k"))).alias("props"),
    )
    parts = spark.range(1000).select(
        F.col("id").alias("p_partkey"), F.lit("ring").alias("p_name"), F.lit("SMALL").alias("p_type")
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    parts.write.parquet(str(tmp_path / "part.parquet"))
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    with settings(spark, small) as own:
        feed = raw_feed(own, str(tmp_path))
        rows = feed.collect()
        assert "skew=true" in plan(feed)
    assert len(rows) == 110_000 - sum(n % 10 == 7 and n % 71 == 0 for n in range(100_000))
    assert all(row.product_name.startswith("ring") for row in rows)
