"""One row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.schema import KEY


def one_per_key(rows: DataFrame, key: str = KEY) -> DataFrame:
    """Keep the smallest row of each key, compared column by column from left to right.

    The survivor does not depend on how the rows were partitioned. As an aggregate it is
    combined before the shuffle: each task sends at most one row per key, so a key that holds
    a third of all rows costs no more than any other.
    """
    columns = rows.columns
    rest = ", ".join(f"`{name}`" for name in columns if name != key)
    smallest = rows.groupBy(key).agg(F.expr(f"min(struct({rest}))").alias("kept"))
    unique = smallest.select(key, "kept.*")
    return unique if columns[0] == key else unique.select(*columns)
