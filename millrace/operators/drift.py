"""Detection of change in what batches reject and how long triggers take.

A one-sided CUSUM: a value's excess over its reference mean, less a slack, is added up and never
falls below zero; a batch is flagged when the sum exceeds the limit. A short spike and a small
lasting rise both show, noise within the slack does not. The sum is a running total less its own
least value so far, so it is two windows and no loop.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def cusum(
    values: DataFrame, series: str, order: str, value: str, reference: int, slack: float, limit: float
) -> DataFrame:
    """The rows with `mean`, `statistic` and `flagged`.

    The mean of a series is that of its first `reference` rows by `order`. There is one row per
    series and batch, so a series is as long as there are batches.
    """
    whole = Window.partitionBy(series)
    ordered = whole.orderBy(order)
    far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = F.when(F.row_number().over(ordered) <= reference, F.col(value))
    rows = values.withColumn("_first", first).withColumn("mean", F.avg("_first").over(whole))
    excess = F.col(value) - F.col("mean") - F.lit(slack)
    rows = rows.withColumn("_total", F.sum(excess).over(far))
    least = F.least(F.min("_total").over(far), F.lit(0.0))
    rows = rows.withColumn("statistic", F.col("_total") - least)
    return rows.withColumn("flagged", F.col("statistic") > limit).drop("_first", "_total")


def slow_triggers(triggers: DataFrame, reference: int, slack: float, limit: float) -> DataFrame:
    """Change in the seconds that triggers take, from the rows of a `ProgressLog`."""
    series = triggers.withColumn("series", F.lit("trigger_s"))
    found = cusum(series, "series", "batch_id", "trigger_s", reference, slack, limit)
    return found.drop("series")


def reject_shares(counted: DataFrame, reasons: list[str]) -> DataFrame:
    """Rows of a `RejectLog` as batch_id, rows, reason, rejected, share."""
    long = counted.unpivot(["batch_id", "rows"], reasons, "reason", "rejected")
    return long.withColumn("share", F.col("rejected") / F.col("rows"))
