"""Figures of a stored table that are kept up to date batch by batch.

Each batch leaves a few rows: per action its number of events, a theta sketch of its keys and a
KLL sketch of its prices. All three merge, so questions to the whole table read these rows and no
event, and a batch that is written again replaces its own.

How exact the answers are: counts are exact. A theta sketch of fewer than 2**LG_KEYS keys is
exact; beyond that its estimate of a union is off by 1 / sqrt(2**LG_KEYS) of the union (one
standard deviation, 0.8 %), and so are those of intersections and differences, of the union too.
A KLL sketch gives values whose rank is off by at most RANK_ERROR of all ranks (at 99 %).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.schema import KEY

LG_KEYS = 14
KLL_SIZE = 400
RANK_ERROR = 0.0075

SUMMARY_SCHEMA = (
    T.StructType()
    .add("action", "string")
    .add("n", "long")
    .add("keys", "binary")
    .add("prices", "binary")
)


def summarise(events: DataFrame) -> DataFrame:
    """The rows that a batch leaves; what a task sends on is combined before the shuffle."""
    return events.groupBy("action").agg(
        F.count(F.lit(1)).alias("n"),
        F.theta_sketch_agg(KEY, LG_KEYS).alias("keys"),
        F.kll_sketch_agg_double(F.col("price").cast("double"), KLL_SIZE).alias("prices"),
    )


def counts(parts: DataFrame) -> DataFrame:
    """Events per action."""
    return parts.groupBy("action").agg(F.sum("n").alias("n"))


def total(parts: DataFrame) -> DataFrame:
    """One row with the number of events."""
    return parts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def price_quantiles(parts: DataFrame, ranks: list[float]) -> DataFrame:
    """Per action the number of prices, and for each rank the price at it: action, n, rank, price."""
    merged = parts.groupBy("action").agg(F.kll_merge_agg_double("prices", KLL_SIZE).alias("prices"))
    return quantiles(merged, "prices", ranks).withColumnRenamed("value", "price")


def quantiles(sketches: DataFrame, column: str, ranks: list[float]) -> DataFrame:
    """The rows of sketches that hold something, with n, rank and value in place of the sketch."""
    n = F.kll_sketch_get_n_double(column)
    filled = sketches.withColumn("n", n).where("n > 0")
    wanted = F.array(*map(F.lit, ranks))
    pairs = F.arrays_zip(
        wanted.alias("rank"), F.kll_sketch_get_quantile_double(column, wanted).alias("value")
    )
    return filled.withColumn("_pair", F.explode(pairs)).select(
        *(name for name in filled.columns if name != column), "_pair.rank", "_pair.value"
    )


def metric_sketches(metrics: DataFrame, batches_each: int = 1000) -> DataFrame:
    """A sketch of each measure for every group of batches: group, measure, values."""
    names = ("rows", "seconds", "rows_per_s")
    columns = [F.col(name).cast("double").alias(name) for name in names]
    group = F.floor(F.col("batch_id") / batches_each).alias("group")
    values = metrics.select(group, *columns).unpivot(["group"], list(names), "measure", "value")
    return values.groupBy("group", "measure").agg(
        F.kll_sketch_agg_double("value", KLL_SIZE).alias("values")
    )


def metric_quantiles(sketches: DataFrame, ranks: list[float]) -> DataFrame:
    """Over all groups: measure, n, rank, value."""
    merged = sketches.groupBy("measure").agg(F.kll_merge_agg_double("values", KLL_SIZE).alias("values"))
    return quantiles(merged, "values", ranks)


def rank_is_near(below: Column, up_to: Column, n: Column, rank: Column) -> Column:
    """Whether a value with so many values below it and up to it stands near enough at a rank."""
    error = F.lit(RANK_ERROR) + 1 / n
    return (below / n <= rank + error) & (up_to / n >= rank - error)


def key_sketches(parts: DataFrame) -> DataFrame:
    """One sketch of keys per batch: batch_id, keys."""
    return parts.groupBy("batch_id").agg(F.theta_union_agg("keys", LG_KEYS).alias("keys"))


def compared_keys(sketches: DataFrame) -> DataFrame:
    """For each two batches how many keys they have together, in common, and only the later one.

    earlier, later, measure (union, repeated, new), estimate, error (three standard deviations).
    """
    earlier = sketches.select(F.col("batch_id").alias("earlier"), F.col("keys").alias("a"))
    later = sketches.select(F.col("batch_id").alias("later"), F.col("keys").alias("b"))
    pairs = earlier.join(later, F.col("earlier") < F.col("later"))  # one small row per batch

    def estimate(sketch: Column) -> Column:
        return F.theta_sketch_estimate(sketch)

    both = estimate(F.theta_union("a", "b", LG_KEYS))
    found = pairs.select(
        "earlier",
        "later",
        both.alias("union"),
        estimate(F.theta_intersection("a", "b")).alias("repeated"),
        estimate(F.theta_difference("b", "a")).alias("new"),
        F.when(both < 1 << LG_KEYS, 0.0).otherwise(3 * both / math.sqrt(1 << LG_KEYS)).alias("error"),
    )
    return found.unpivot(
        ["earlier", "later", "error"], ["union", "repeated", "new"], "measure", "estimate"
    )
