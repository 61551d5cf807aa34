from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import NumberFormatException
from pyspark.sql import functions as F

from millrace.functions.rules import cast_lost, is_valid, reject_reason, safe
from millrace.operators.clean import clean, default_ingest_time, rejects, strict_events
from millrace.schema import event_columns


def one(frame):
    (row,) = frame.collect()
    return row[0]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("12", 12),
        (" 4 ", 4),
        ("+7", 7),
        ("-7", -7),
        ("5.9", None),
        ("1e3", None),
        ("1_000", None),
        ("2147483647", 2147483647),
        ("2147483648", None),
        ("", None),
        ("x12", None),
        (None, None),
    ],
)
def test_integer_text(raw, text, expected):
    assert one(raw({"user_id": text}).select(safe("user_id"))) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("10.555", "10.56"),
        ("1.005", "1.01"),
        ("-0.005", "-0.01"),
        ("1e3", "1000.00"),
        ("99999999999.5", None),
        ("abc", None),
        ("", None),
    ],
)
def test_price_text(raw, text, expected):
    found = one(raw({"price": text}).select(safe("price")))
    assert found == (Decimal(expected) if expected else None)


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("not_a_timestamp", None),
        ("2026-01-05", datetime(2026, 1, 5)),
        ("2026", datetime(2026, 1, 1)),
        ("2026-01-05T10:15:30+05:00", datetime(2026, 1, 5, 5, 15, 30)),
        ("2026-01-05T10:15:30.123456+00:00", datetime(2026, 1, 5, 10, 15, 30, 123456)),
        ("", None),
    ],
)
def test_time_text(raw, text, expected):
    found = raw({"event_time": text}).select(safe("event_time").cast("timestamp_ntz"))
    assert one(found) == expected


@pytest.mark.parametrize(("text", "kept"), [("12:30:00", False), ("2026", False), ("2026-1-5", True)])
def test_strict_time_asks_for_a_date(raw, text, kept):
    rows = raw({"event_time": text})
    assert one(rows.select(is_valid())) is True
    assert one(rows.select(is_valid(strict_time=True))) is kept
    assert clean(rows, strict_time=True).count() == int(kept)


@pytest.mark.parametrize(
    ("change", "reason"),
    [
        ({}, None),
        ({"action": "click"}, "bad_action"),
        ({"action": "View"}, "bad_action"),
        ({"action": None}, "bad_action"),
        ({"event_id": None}, "missing_event_id"),
        ({"event_time": "not_a_timestamp"}, "bad_event_time"),
        ({"event_time": None}, "bad_event_time"),
        ({"user_id": "x1"}, "bad_user_id"),
        ({"product_id": None}, "bad_product_id"),
        ({"product_id": "5.9"}, "bad_product_id"),
        ({"action": "click", "event_id": None}, "bad_action"),
        ({"action": "purchase", "price": None}, None),
        ({"action": "purchase", "price": "abc", "quantity": "1.5"}, None),
        ({"product_name": None, "category": None, "source": None}, None),
    ],
)
def test_first_broken_rule(raw, change, reason):
    rows = raw(change)
    assert one(rows.select(reject_reason())) == reason
    assert clean(rows).count() == (reason is None)
    assert rejects(rows).count() == (reason is not None)


def test_clean_shape(raw):
    events = clean(raw({"action": "purchase", "price": "9.99", "quantity": "2"}), "processed_at")
    assert events.columns == event_columns("processed_at")
    assert events.columns[:3] == ["event_id", "event_time", "processed_at"]
    types = dict(events.dtypes)
    assert (types["user_id"], types["price"], types["event_time"]) == (
        "int",
        "decimal(10,2)",
        "timestamp",
    )
    assert events.first()["price"] == Decimal("9.99")


def test_every_row_is_clean_or_rejected(raw):
    rows = raw({}, {"action": None}, {"event_id": None}, {"user_id": "?"}, {"event_id": "b"})
    assert clean(rows).count() + rejects(rows).count() == rows.count()


def test_cast_loss_is_not_absence(raw):
    rows = raw({"price": "abc"}, {"price": None}, {"price": "1.00"})
    assert [r[0] for r in rows.select(cast_lost("price")).collect()] == [True, False, False]


def test_strict_cast_raises(raw):
    assert strict_events(raw({})).first()["user_id"] == 1
    with pytest.raises(NumberFormatException):
        strict_events(raw({"user_id": "x1"})).collect()


def test_ingest_time_default(raw):
    events = clean(raw({})).withColumn("stored_at", F.lit(None).cast("timestamp"))
    assert default_ingest_time(events).first()["stored_at"] is not None
