"""The table's constraints as queries that count violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.rules import cast_lost, is_valid, safe
from millrace.schema import ACTIONS, INGEST_TIME, KEY, REQUIRED, TYPED


def _checks(columns: list[str], strict_time: bool) -> dict[str, Column]:
    """A row-level test per constraint; true marks a violation."""
    checks = {f"null_{name}": safe(name, strict_time).isNull() for name in REQUIRED}
    if INGEST_TIME in columns:
        checks[f"null_{INGEST_TIME}"] = F.col(INGEST_TIME).isNull()
    checks["action_domain"] = ~F.coalesce(F.col("action").isin(*ACTIONS), F.lit(False))
    lossy = [name for name in TYPED if name not in REQUIRED]
    checks |= {f"cast_loss_{name}": cast_lost(name) for name in lossy}
    return checks


def audit(rows: DataFrame, strict_time: bool = False) -> DataFrame:
    """Violations per constraint, for raw text rows or for a stored table.

    `unique_event_id` counts the surplus rows among the valid ones. Everything comes from one
    scan and one shuffle: counts per key are combined before the shuffle, then added up.
    """
    checks = _checks(rows.columns, strict_time)
    per_key = rows.groupBy(KEY).agg(
        F.count_if(is_valid(strict_time, rows.columns)).alias("valid"),
        *(F.count_if(test).alias(name) for name, test in checks.items()),
    )
    surplus = F.sum(F.greatest(F.col("valid") - 1, F.lit(0)))
    totals = per_key.agg(
        F.coalesce(surplus, F.lit(0)).alias(f"unique_{KEY}"),
        *(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in checks),
    )
    return totals.unpivot([], totals.columns, "constraint_name", "violations")


def require_clean(rows: DataFrame) -> DataFrame:
    """`rows` itself if they break no constraint, else an error that names the broken ones."""
    broken = audit(rows).where("violations > 0").collect()  # one row per constraint at most
    if broken:
        raise ValueError(", ".join(f"{row.constraint_name}: {row.violations}" for row in broken))
    return rows
