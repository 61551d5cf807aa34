"""Figures kept up to date, sketches, change detection, heavy values."""

from __future__ import annotations

import random

import pytest
from hypothesis import given
from hypothesis import settings as limits
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import drift, heavy, summaries
from millrace.schema import event_schema
from millrace.session import settings
from millrace.sinks.files import BatchTable
from millrace.sinks.filters import KeyFilters
from millrace.streaming import batches, jobs


def test_counts_read_only_the_figures(spark, put_csv, tmp_path):
    for number in range(3):
        rows = [{"event_id": f"e{number}-{k}"} for k in range(4)]
        folder = put_csv(f"{number}.csv", *rows, {"event_id": "p", "action": "purchase", "price": "2.50"})
    table = BatchTable(spark, str(tmp_path / "table"))
    parts = BatchTable(spark, str(tmp_path / "figures"), summaries.SUMMARY_SCHEMA)
    unique = batches.to_unique_table(table, KeyFilters(str(tmp_path / "filters")))
    stream = jobs.StreamJob(folder, str(tmp_path / "progress"), None, max_files=1)
    jobs.start_batches(spark, stream, batches.with_summaries(unique, table, parts)).awaitTermination()
    parts.replace(summaries.summarise(table.read_batches(spark, [1])), 1)  # a replay
    figures = parts.read(spark)
    found = summaries.counts(figures)
    assert {(r.action, r.n) for r in found.collect()} == {("view", 12), ("purchase", 1)}
    assert summaries.total(figures).first().n == 13
    assert found.inputFiles() and all("/figures/" in name for name in found.inputFiles())
    prices = summaries.price_quantiles(figures, [0.5]).collect()
    assert [(r.action, r.n, r.price) for r in prices] == [("purchase", 1, 2.5)]


def test_quantiles_are_within_their_bound(spark):
    """Merged from many sketches of different sizes, against exact ranks."""
    draw = random.Random(1)
    rows = [(b, float(draw.expovariate(1)) if b % 2 else float(draw.randrange(50))) for b in range(40) for _ in range(100 * (1 + b))]
    values = spark.createDataFrame(rows, "batch long, value double")
    sketches = values.groupBy("batch").agg(F.kll_sketch_agg_double("value", summaries.KLL_SIZE).alias("s"))
    merged = sketches.agg(F.kll_merge_agg_double("s", summaries.KLL_SIZE).alias("s"))
    ranks = [0.0, 0.01, 0.1, 0.5, 0.9, 0.99, 1.0]
    found = summaries.quantiles(merged, "s", ranks).collect()
    assert [r["rank"] for r in found] == ranks and {r.n for r in found} == {len(rows)}
    for row in found:
        below = sum(v < row.value for _, v in rows) / len(rows)
        up_to = sum(v <= row.value for _, v in rows) / len(rows)
        assert below - summaries.RANK_ERROR <= row["rank"] <= up_to + summaries.RANK_ERROR


def test_key_sketches_beyond_exact_size(spark):
    schema = "batch_id long, event_id string, action string, price double"
    rows = spark.range(60_000).selectExpr(
        "0L AS batch_id", "concat('k', id) AS event_id", "'view' AS action", "cast(id AS double) AS price"
    ).unionAll(spark.range(40_000, 90_000).selectExpr("1L", "concat('k', id)", "'view'", "0.0"))
    assert [f.dataType for f in rows.schema] == [f.dataType for f in spark.createDataFrame([], schema).schema]
    parts = None
    for number in (0, 1):
        one = summaries.summarise(rows.where(F.col("batch_id") == number)).withColumn("batch_id", F.lit(number))
        parts = one if parts is None else parts.unionAll(one)
    found = {r.measure: r for r in summaries.compared_keys(summaries.key_sketches(parts)).collect()}
    for measure, exact in {"union": 90_000, "repeated": 20_000, "new": 30_000}.items():
        assert 0 < found[measure].error < 0.03 * 90_000
        assert abs(found[measure].estimate - exact) <= found[measure].error


def test_no_figures(spark):
    none = spark.createDataFrame([], event_schema())
    parts = summaries.summarise(none)
    assert parts.collect() == [] and summaries.total(parts).first().n == 0
    assert summaries.price_quantiles(parts, [0.5]).collect() == []


@given(st.lists(st.floats(0, 1), min_size=1, max_size=30))
@limits(max_examples=15, deadline=None)
def test_cusum_equals_the_loop(spark, values):
    rows = spark.createDataFrame([("a", i, v) for i, v in enumerate(values)], "s string, i long, v double")
    found = drift.cusum(rows, "s", "i", "v", reference=5, slack=0.02, limit=0.3).orderBy("i").collect()
    first = values[:5]
    mean, total = sum(first) / len(first), 0.0
    for row, value in zip(found, values, strict=True):
        total = max(0.0, total + value - mean - 0.02)
        assert row.statistic == pytest.approx(total, abs=1e-9)
        assert row.flagged == (row.statistic > 0.3)


def test_a_lasting_rise_is_flagged_and_noise_is_not(spark):
    draw = random.Random(3)
    noise = [0.1 + draw.uniform(-0.02, 0.02) for _ in range(40)]
    risen = [v + (0.04 if i >= 25 else 0) for i, v in enumerate(noise)]
    rows = [("noise", i, v) for i, v in enumerate(noise)] + [("risen", i, v) for i, v in enumerate(risen)]
    found = drift.cusum(spark.createDataFrame(rows, "s string, i long, v double"), "s", "i", "v", 20, 0.02, 0.08)
    flagged = {(r.s, r.i) for r in found.where("flagged").collect()}
    assert flagged and {s for s, _ in flagged} == {"risen"} and min(i for _, i in flagged) in range(27, 35)


def test_slower_triggers_are_flagged(spark):
    rows = [(i, 10, 0.2 + (0.3 if i >= 15 else 0.02 * (i % 2)), 50.0) for i in range(20)]
    triggers = spark.createDataFrame(rows, "batch_id long, input_rows long, trigger_s double, rows_per_s double")
    found = drift.slow_triggers(triggers, reference=10, slack=0.05, limit=0.4)
    assert {r.batch_id for r in found.where("flagged").collect()} == {16, 17, 18, 19}


@given(st.lists(st.lists(st.integers(0, 12), max_size=30), max_size=5), st.integers(1, 6))
@limits(max_examples=200, deadline=None)
def test_counters_are_too_low_by_a_bounded_number(parts, size):
    """Also after counts of several tasks are added up."""
    sums, rows = {}, [value for part in parts for value in part]
    for part in parts:
        counters = heavy.SpaceSaving(size)
        for low in range(0, len(part), 7):
            some = part[low : low + 7]
            counters.add(sorted(set(some)), [some.count(v) for v in sorted(set(some))])
        assert len(counters.counts) <= size and counters.rows == len(part)
        for value, count in counters.counts.items():
            sums[value] = sums.get(value, 0) + count
    for value in set(rows):
        assert rows.count(value) - len(rows) / (size + 1) <= sums.get(value, 0) <= rows.count(value)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of 30,000 rows have one value, a tenth another; the rest 3,000 of them."""
    value = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, 8).otherwise(F.col("id") % 3000 + 100)
    return spark.range(30_000).select("id", value.cast("int").alias("product")).repartition(6).persist()


def test_heavy_values_are_counted_exactly(spark, skewed):
    exact = {r.product: r["count"] for r in skewed.groupBy("product").count().collect()}
    found = {r.value: r.n for r in heavy.heavy_values(skewed, "product", 0.01).collect()}
    assert found == {v: n for v, n in exact.items() if n > 300} and {7, 8} <= set(found)
    nothing = skewed.where("id < 0")
    assert heavy.heavy_values(nothing, "product", 0.01).collect() == []
    assert heavy.heavy_values(nothing.selectExpr("NULL AS v"), "v", 0.5).collect() == []


def test_salted_join_spreads_heavy_values(spark, skewed):
    plain = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.shuffle.partitions": "12"}
    names = spark.range(3200).selectExpr("cast(id AS int) AS product", "concat('p', id) AS name").where("product <> 8")
    many = [r.value for r in heavy.heavy_values(skewed, "product", 0.01).collect()]
    with settings(spark, plain) as own:
        path = own.conf.get("spark.sql.warehouse.dir")
        assert path
        left = own.createDataFrame(skewed.toArrow())
        right = own.createDataFrame(names.toArrow())
        salted = heavy.salted_join(left, right, "product", many, 24, F.col("id"))
        usual = left.join(right, "product", "left")

        def largest(rows):
            sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id().alias("p")).count().collect()]
            return max(sizes) / sorted(sizes)[len(sizes) // 2]

        assert largest(usual) > 4 and largest(salted) < 2
        columns = ["id", "product", "name"]
        assert salted.select(columns).exceptAll(usual.select(columns)).isEmpty()
        assert salted.count() == 30_000
