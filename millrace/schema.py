"""The event record: column names, types and table constraints in one place."""

from __future__ import annotations

from pyspark.sql import types as T

# Columns of an event file, in file order.
RAW_COLUMNS = (
    "event_id",
    "event_time",
    "user_id",
    "action",
    "product_id",
    "product_name",
    "category",
    "price",
    "quantity",
    "source",
)

# Target types of the columns that are not text.
TYPED = {
    "event_time": "timestamp",
    "user_id": "int",
    "product_id": "int",
    "price": "decimal(10,2)",
    "quantity": "int",
}

# The only actions a stored event may have.
ACTIONS = ("view", "purchase")

KEY = "event_id"
INGEST_TIME = "stored_at"
# Folders of a table that is laid out for lookups.
DAY = "event_date"
# The event time as a number, in a table that is laid out along a curve.
MICROS = "event_micros"

# Columns a stored row must have a value in (the ingest time has a default).
REQUIRED = ("event_id", "event_time", "user_id", "action", "product_id")

RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])

# Where readers of event files keep a line that has too few or too many fields.
MALFORMED = "malformed"


def event_columns(ingest_time: str = INGEST_TIME) -> list[str]:
    """Column order of the stored table; the ingest time follows the event time."""
    head, tail = RAW_COLUMNS[:2], RAW_COLUMNS[2:]
    return [*head, ingest_time, *tail]


def event_schema(ingest_time: str = INGEST_TIME) -> T.StructType:
    """Schema of the stored table."""
    types = {**TYPED, ingest_time: "timestamp"}
    ddl = ", ".join(f"{name} {types.get(name, 'string')}" for name in event_columns(ingest_time))
    return T.StructType.fromDDL(ddl)
