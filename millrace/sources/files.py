"""Event files: a folder of CSV read at once or as a stream, and Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from millrace.schema import MALFORMED, RAW_SCHEMA

# A quote within a quoted field is doubled, as most writers of CSV do.
QUOTING = {"quote": '"', "escape": '"'}
# A line with too few or too many fields is kept whole in this column.
SCHEMA = T.StructType([*RAW_SCHEMA.fields]).add(MALFORMED, "string")


def _csv_options(strict_header: bool, multi_line: bool) -> dict[str, str]:
    return {
        "header": "true",
        **QUOTING,
        # Line breaks within quotes. Such files are read by one task each, so off by default.
        "multiLine": str(multi_line).lower(),
        "mode": "PERMISSIVE",
        # The width of a line shows only when all its fields are parsed.
        "columnPruning": "false",
        "columnNameOfCorruptRecord": MALFORMED,
        # Only finished files: writers may leave others in the watched folder.
        "pathGlobFilter": "*.csv",
        "recursiveFileLookup": "true",
        # With false, a header in another order is an error instead of being read by position.
        "enforceSchema": str(not strict_header).lower(),
    }


def read_events(
    spark: SparkSession, path: str, strict_header: bool = False, multi_line: bool = False
) -> DataFrame:
    """All event files under a folder, every column as text.

    `malformed` holds the line where its number of fields is not that of the columns, else NULL.
    """
    options = _csv_options(strict_header, multi_line)
    return spark.read.schema(SCHEMA).options(**options).csv(path)


def watch_events(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    max_bytes: str | None = None,
    strict_header: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """The folder as a stream: each file is read once per checkpoint.

    Without a limit the first batch takes every waiting file. `max_files` or `max_bytes`
    (one of them) bounds a batch, which bounds what a catch-up batch shuffles.
    """
    limits = {"maxFilesPerTrigger": max_files, "maxBytesPerTrigger": max_bytes}
    limits = {name: value for name, value in limits.items() if value is not None}
    reader = spark.readStream.schema(SCHEMA).options(**_csv_options(strict_header, multi_line))
    return reader.options(**limits).csv(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored Parquet table."""
    return spark.read.parquet(path)
