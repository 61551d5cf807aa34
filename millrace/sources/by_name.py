"""Event files read by the names in their headers, whatever order their columns are in.

Files come as lines. A file's header is the line that names the
key column; every other line is matched with its own file's header. Columns that a file lacks are
NULL, columns that are not part of an event are kept by name in `others`. Batch and stream alike:
a stream hands out whole files, so a batch has the header of each of its lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.schema import KEY, MALFORMED, RAW_COLUMNS
from millrace.sources.files import QUOTING

# Fields of a line at most; columns beyond them are not read.
WIDTH = 64
# Lines with quotes are parsed to the first of these widths that holds them: Spark's parser takes
# much longer for a line that has far fewer fields than its schema.
WIDTHS = (16, WIDTH)

OPTIONS = {**QUOTING, "mode": "PERMISSIVE"}
FILES = {"pathGlobFilter": "*.csv", "recursiveFileLookup": "true"}


def _parsed(line: Column, width: int) -> Column:
    """The fields of a line by Spark's CSV parser, which is called once for all of them."""
    names = [f"field_{i}" for i in range(width)]
    row = F.from_csv(line, ", ".join(f"{name} string" for name in names), OPTIONS)
    return F.transform(F.array(row), lambda x: F.array(*(x[name] for name in names)))[0]


def split_fields(line: Column) -> Column:
    """The fields of a line of CSV, an empty one as NULL. Without quotes they stand between commas."""
    plain = F.slice(F.split(line, ",", -1), 1, WIDTH)
    fields = F.transform(plain, lambda x: F.when(x != "", x))
    for width in reversed(WIDTHS):
        quoted = line.contains('"')
        if width < WIDTH:
            quoted &= F.length(line) - F.length(F.replace(line, F.lit(","), F.lit(""))) < width
        fields = F.when(quoted, _parsed(line, width)).otherwise(fields)
    return fields


def _with_fields(lines: DataFrame) -> DataFrame:
    """Lines with their fields, without empty ones at their end, and their number (`width`)."""
    found = lines.select("file", "line", split_fields(F.col("line")).alias("fields"))
    last = F.transform("fields", lambda x, i: F.when(x.isNotNull(), i + 1))
    width = F.coalesce(F.array_max(last), F.lit(0))
    return found.select("file", "line", F.slice("fields", F.lit(1), width).alias("fields"), width.alias("width"))


def _lines(rows: DataFrame) -> DataFrame:
    """Each line that is not blank, and its file."""
    line = F.make_valid_utf8("value")
    lines = rows.select(F.col("_metadata.file_path").alias("file"), line.alias("line"))
    return lines.where(lines["line"].rlike(r"[^\x00-\x20]"))


def _may_be_header() -> Column:
    """A cheap test before the exact one, which needs the fields."""
    return F.col("line").contains(KEY)


def _is_header() -> Column:
    return _may_be_header() & F.exists("fields", lambda x: F.trim(x).eqNullSafe(KEY))


def _layouts(lines: DataFrame) -> DataFrame:
    """For each file with a header the number of its columns, and where they stand, from 0.

    `places` are those of the columns of an event, less than 0 for one that the file lacks.
    """
    named = _with_fields(lines.where(_may_be_header()))
    headers = named.where(_is_header()).groupBy("file").agg(
        F.min(F.struct("width", "fields")).alias("header")
    )
    headers = headers.select("file", F.transform("header.fields", lambda x: F.trim(x)).alias("names"))
    places = F.array(*(F.array_position("names", name).cast("int") - 1 for name in RAW_COLUMNS))
    columns = F.transform("names", lambda x, i: F.struct(x.alias("name"), i.alias("place")))
    others = F.filter(columns, lambda p: ~p["name"].isin(*RAW_COLUMNS))
    return headers.select(
        "file", F.size("names").alias("columns"), places.alias("places"), others.alias("others")
    )


def named_events(lines: DataFrame) -> DataFrame:
    """Lines of files (file, line) as raw events, with `malformed` and `others`.

    One small row per file is joined with its lines. These are broadcast, so that the lines stay
    where they are; the driver lists the files anyway.
    """
    rows = _with_fields(lines).where(~_is_header()).join(F.broadcast(_layouts(lines)), "file", "left")
    values = [F.get("fields", F.get("places", F.lit(i))).alias(name) for i, name in enumerate(RAW_COLUMNS)]
    found = F.transform("others.place", lambda place: F.get("fields", place))
    wide = F.col("columns").isNull() | (F.col("width") > F.col("columns"))
    return rows.select(
        *values,
        F.when(wide, F.concat_ws(",", "fields")).alias(MALFORMED),
        F.map_from_arrays("others.name", found).alias("others"),
    )


def read_events_by_name(spark: SparkSession, path: str) -> DataFrame:
    """All event files under a folder, each by its own header.

    A line with more fields than its header names is `malformed`, as is every line of a file
    without a header; missing fields at the end of a line are NULL.
    """
    return named_events(_lines(spark.read.options(**FILES).text(path)))


def watch_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The folder as a stream of lines, for `named_events` within each batch."""
    reader = spark.readStream.options(**FILES)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return _lines(reader.text(path))
