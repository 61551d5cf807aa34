"""The questions asked of the stored table: counts, latest rows, lookups, batch summaries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.schema import DAY, INGEST_TIME, KEY, MICROS


def row_count(rows: DataFrame) -> DataFrame:
    """One row with the number of rows."""
    return rows.agg(F.count(F.lit(1)).alias("n"))


def action_counts(events: DataFrame) -> DataFrame:
    """Events per action."""
    return events.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


def distinct_keys(events: DataFrame, key: str = KEY) -> DataFrame:
    """One row with the number of different keys."""
    return events.agg(F.count_distinct(key).alias("n"))


def latest(events: DataFrame, k: int = 5, by: str = INGEST_TIME, key: str = KEY) -> DataFrame:
    """The k newest rows. Rows of one batch share their ingest time, so the key breaks ties."""
    return events.orderBy(F.col(by).desc(), F.col(key)).limit(k)


def in_time_range(events: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Events from `start` up to, not including, `end`.

    A table laid out by day is read in the folders of those days only, one along a curve in the
    row groups whose statistics allow the times.
    """
    found = (F.col("event_time") >= F.lit(start)) & (F.col("event_time") < F.lit(end))
    if DAY in events.columns:
        found = found & F.col(DAY).between(F.to_date(F.lit(start)), F.to_date(F.lit(end)))
    if MICROS in events.columns:
        low, high = (F.unix_micros(F.lit(moment).cast("timestamp")) for moment in (start, end))
        found = found & (F.col(MICROS) >= low) & (F.col(MICROS) < high)
    return events.where(found)


def of_user(events: DataFrame, user_id: int) -> DataFrame:
    """Events of one user."""
    return events.where(F.col("user_id") == user_id)


def of_product(events: DataFrame, product_id: int) -> DataFrame:
    """Events about one product."""
    return events.where(F.col("product_id") == product_id)


def of_action(events: DataFrame, action: str) -> DataFrame:
    """Events of one action."""
    return events.where(F.col("action") == action)


def summarise_batches(metrics: DataFrame) -> DataFrame:
    """Smallest, largest, mean and typical value of rows, seconds and rows per second.

    `typical` is the median as percentile_approx gives it.
    """
    values = metrics.unpivot(
        ["batch_id"],
        [F.col(name).cast("double").alias(name) for name in ("rows", "seconds", "rows_per_s")],
        "measure",
        "value",
    )
    return values.groupBy("measure").agg(
        F.count("value").alias("batches"),
        F.min("value").alias("lowest"),
        F.max("value").alias("highest"),
        F.avg("value").alias("mean"),
        F.percentile_approx("value", 0.5, 10000).alias("typical"),
    )


def falling_behind(triggers: DataFrame, interval: float) -> DataFrame:
    """Each batch with a flag that says its whole trigger took longer than the interval.

    `trigger_s` counts everything from listing files to committing progress, as `progress` has
    it: a batch whose own write is quick may still hold up the next one.
    """
    late = F.col("trigger_s") > F.lit(float(interval))
    return triggers.withColumns({"interval_s": F.lit(float(interval)), "behind": late})
