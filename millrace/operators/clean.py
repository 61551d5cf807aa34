"""From raw text rows to typed, valid events. All transforms serve batch and stream alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.rules import is_valid, reject_reason, safe_columns, strict
from millrace.schema import INGEST_TIME, RAW_COLUMNS, event_columns


def clean(raw: DataFrame, ingest_time: str = INGEST_TIME, strict_time: bool = False) -> DataFrame:
    """Valid rows in target types and target column order, stamped with the ingest time.

    The filter stands on the raw columns, so the scan can take the parts it understands. Rows
    that were stamped before keep their ingest time.
    """
    typed = safe_columns(strict_time)
    stamped = ingest_time in raw.columns
    typed[ingest_time] = F.col(ingest_time) if stamped else F.current_timestamp()
    return raw.where(is_valid(strict_time, raw.columns)).select(
        *(typed[name].alias(name) for name in event_columns(ingest_time))
    )


def rejects(raw: DataFrame, strict_time: bool = False) -> DataFrame:
    """The rows `clean` leaves out, as they arrived, with the first rule each one breaks."""
    reason = reject_reason(strict_time, raw.columns)
    return raw.withColumn("reason", reason).where("reason IS NOT NULL")


def strict_events(rows: DataFrame, ingest_time: str = INGEST_TIME) -> DataFrame:
    """Rows already known to be good, in target types; a value that does not convert raises."""
    typed = {name: strict(name) for name in RAW_COLUMNS}
    typed[ingest_time] = F.current_timestamp()
    return rows.select(*(typed[name].alias(name) for name in event_columns(ingest_time)))


def default_ingest_time(events: DataFrame, ingest_time: str = INGEST_TIME) -> DataFrame:
    """Fill a missing ingest time with now, as the table's column default does."""
    return events.withColumn(
        ingest_time, F.coalesce(F.col(ingest_time), F.current_timestamp())
    )
