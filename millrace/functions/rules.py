"""Column expressions: safe casts, validity rules and the reason a row is rejected."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.schema import ACTIONS, MALFORMED, RAW_COLUMNS, TYPED

# A time needs a calendar date in front; "12:30" alone would otherwise mean today.
DATED = r"^\s*\d{4}-\d{1,2}-\d{1,2}"


def safe(name: str, strict_time: bool = False) -> Column:
    """The column in its target type; NULL where the text does not convert."""
    raw = F.col(name)
    if name not in TYPED:
        return raw
    cast = raw.try_cast(TYPED[name])
    if strict_time and TYPED[name] == "timestamp":
        return F.when(raw.cast("string").rlike(DATED), cast)
    return cast


def strict(name: str) -> Column:
    """The column in its target type; text that does not convert is an error (ANSI mode)."""
    return F.col(name).cast(TYPED[name]) if name in TYPED else F.col(name)


def safe_columns(strict_time: bool = False) -> dict[str, Column]:
    """Every event column in its target type, by name."""
    return {name: safe(name, strict_time) for name in RAW_COLUMNS}


def rules(strict_time: bool = False, columns: Iterable[str] = ()) -> dict[str, Column]:
    """What a stored row must satisfy, by the reason for rejecting it, in checking order.

    Price, quantity, source and the product texts may be missing: no rule covers them. Rows that
    say whether their line was well formed (`columns` names the column) must be so.
    """
    formed = {"bad_width": F.col(MALFORMED).isNull()} if MALFORMED in columns else {}
    return formed | {
        "bad_action": F.col("action").isin(*ACTIONS),
        "missing_event_id": F.col("event_id").isNotNull(),
        "bad_event_time": safe("event_time", strict_time).isNotNull(),
        "bad_user_id": safe("user_id").isNotNull(),
        "bad_product_id": safe("product_id").isNotNull(),
    }


def is_valid(strict_time: bool = False, columns: Iterable[str] = ()) -> Column:
    """True for rows that satisfy every rule."""
    return reduce(Column.__and__, rules(strict_time, columns).values())


def reject_reason(strict_time: bool = False, columns: Iterable[str] = ()) -> Column:
    """The first rule a row breaks, NULL for a valid row. A NULL action breaks its rule."""
    broken = [
        F.when(~F.coalesce(holds, F.lit(False)), reason)
        for reason, holds in rules(strict_time, columns).items()
    ]
    return F.coalesce(*broken)


def cast_lost(name: str, strict_time: bool = False) -> Column:
    """True where a value is present but does not convert to its target type."""
    return F.col(name).isNotNull() & safe(name, strict_time).isNull()
