from __future__ import annotations

import random
from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import report
from millrace.operators.audit import audit, require_clean
from millrace.operators.clean import clean
from millrace.operators.dedup import one_per_key

# Recorded batches (rows, seconds, rows per second) of a published run with a
# trigger of ten seconds.
RECORDED = [
    (196, 0.88, 223.5),
    (74, 0.20, 375.6),
    (124, 0.25, 487.5),
    (122, 0.20, 621.4),
    (125, 0.19, 664.5),
    (123, 0.19, 663.7),
    (125, 0.26, 477.1),
    (123, 0.18, 688.0),
    (125, 0.21, 588.5),
    (124, 0.15, 802.6),
    (125, 0.22, 571.2),
    (124, 0.18, 687.5),
    (124, 0.20, 621.0),
    (123, 0.19, 646.3),
]


@pytest.fixture(scope="module")
def recorded(spark):
    rows = [(i, *values) for i, values in enumerate(RECORDED)]
    schema = "batch_id long, rows long, seconds double, rows_per_s double"
    return spark.createDataFrame(rows, schema)


def test_one_row_per_key(spark):
    rows = spark.createDataFrame(
        [("a", 2, "y"), ("a", 2, "x"), ("a", 3, "w"), ("b", 1, None), ("b", 1, "z")],
        "event_id string, n int, t string",
    )
    kept = {tuple(row) for row in one_per_key(rows).collect()}
    assert kept == {("a", 2, "x"), ("b", 1, None)}
    assert one_per_key(rows).columns == rows.columns


EVENT = st.tuples(st.sampled_from("abcd"), st.integers(0, 5), st.integers(0, 5))


@settings(max_examples=8, deadline=None)
@given(st.lists(EVENT, min_size=1))
def test_survivor_is_the_smallest_in_any_order(spark, rows):
    expected = {key: min(r for r in rows if r[0] == key) for key, *_ in rows}
    shuffled = random.sample(rows, len(rows))
    frame = spark.createDataFrame(shuffled, "event_id string, x int, y int").repartition(3)
    assert {r[0]: tuple(r) for r in one_per_key(frame).collect()} == expected


def test_hot_key_is_reduced_before_the_shuffle(spark):
    rows = spark.range(30_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("event_id"),
        F.col("id").alias("n"),
    )
    unique = one_per_key(rows)
    assert unique.count() == 20_001
    plan = unique._jdf.queryExecution().executedPlan().toString()
    assert plan.index("min(") < plan.index("Exchange") < plan.rindex("partial_min(")


def violations(frame):
    return {row.constraint_name: row.violations for row in frame.collect()}


def test_audit_of_raw_rows(raw):
    rows = raw(
        {},
        {},
        {},
        {"event_id": None},
        {"event_id": None},
        {"event_id": "b", "action": "click"},
        {"event_id": "b", "action": None},
        {"event_id": "c", "price": "abc", "quantity": "many"},
        {"event_id": "d", "event_time": "?", "user_id": "?", "product_id": "?"},
    )
    assert violations(audit(rows)) == {
        "unique_event_id": 2,
        "null_event_id": 2,
        "null_event_time": 1,
        "null_user_id": 1,
        "null_action": 1,
        "null_product_id": 1,
        "action_domain": 2,
        "cast_loss_price": 1,
        "cast_loss_quantity": 1,
    }


def test_audit_of_nothing_and_gate(raw):
    events = clean(raw({}, {"event_id": "b"}))
    assert set(violations(audit(events)).values()) == {0}
    assert set(violations(audit(events.where("false"))).values()) == {0}
    assert "null_stored_at" in violations(audit(events))
    assert require_clean(events) is events
    with pytest.raises(ValueError, match="unique_event_id: 1"):
        require_clean(clean(raw({}, {})))


def test_latest_breaks_ties_by_key(raw):
    events = clean(raw(*({"event_id": key} for key in "gfedcba")))
    assert [r.event_id for r in report.latest(events).collect()] == list("abcde")


def test_lookups(raw):
    events = clean(
        raw(
            {"event_time": "2026-01-05 00:00:00"},
            {"event_time": "2026-01-05 23:59:59.999999", "user_id": "2", "action": "purchase"},
            {"event_time": "2026-01-06 00:00:00", "product_id": "7"},
        )
    )
    day = report.in_time_range(events, datetime(2026, 1, 5), datetime(2026, 1, 6))
    assert day.count() == 2
    assert report.of_user(events, 2).count() == 1
    assert report.of_product(events, 7).count() == 1
    assert report.of_action(events, "purchase").count() == 1


def test_summary_of_the_recorded_run(recorded):
    summary = {r.measure: r for r in report.summarise_batches(recorded).collect()}
    assert (summary["rows"].lowest, summary["rows"].highest) == (74, 196)
    assert summary["rows"].batches == 14
    assert summary["rows"].mean == pytest.approx(1757 / 14)
    assert 120 <= summary["rows"].typical <= 125
    assert 0.15 <= summary["seconds"].typical <= 0.26
    assert 475 <= summary["rows_per_s"].typical <= 800


def test_falling_behind(spark, recorded):
    triggers = recorded.withColumnRenamed("seconds", "trigger_s")
    assert report.falling_behind(triggers, 10).where("behind").count() == 0
    # The recorded catch-up batch, trigger of five seconds.
    backlog = spark.createDataFrame([(0, 87694, 9.19, 9539.7)], triggers.schema)
    assert report.falling_behind(backlog, 5).first()["behind"] is True
    assert report.falling_behind(backlog, 9.19).first()["behind"] is False


def test_recorded_counts(spark):
    # Recorded counts per action and in total.
    actions = {"view": 1788, "purchase": 440}
    action = F.when(F.col("id") < 1788, "view").otherwise("purchase")
    rows = spark.range(2228).select(action.alias("action"))
    assert dict(map(tuple, report.action_counts(rows).collect())) == actions
    assert report.row_count(rows).first()["n"] == 2228
