"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# What the jobs rely on. Everything else stays as the cluster sets it.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


def session(app_name: str = "millrace", **extra: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``extra`` adds or replaces some."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def scratch(spark: SparkSession, name: str) -> str:
    """A new, unused path under the folder that the cluster names in spark.checkpoint.dir.

    Only where the session names none and runs in one process (tests) a temporary folder is
    used, and the session keeps it for the next call. Elsewhere that is an error: executors
    would each write to a disk of their own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        base = "file:" + tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/millrace/{name}-{uuid.uuid4().hex}"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[SparkSession]:
    """A session of its own with other settings; the given one keeps what it has.

    Two jobs started at the same time do not see each other's. A streaming query keeps the
    settings of the session that it was started from.
    """
    own = spark.newSession()
    for name, value in {**spark.conf.getAll, **values}.items():
        if own.conf.isModifiable(name):
            own.conf.set(name, value)
    yield own


@contextmanager
def kept(rows: DataFrame) -> Iterator[DataFrame]:
    """Rows that several steps need, computed once and dropped after the block."""
    cached = rows.persist()
    try:
        yield cached
    finally:
        cached.unpersist()


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate rows."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _store(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def read_lines(spark: SparkSession, name: str) -> list[str]:
    """Lines of one small file, none if it is not there."""
    store, path = _store(spark, name)
    if not store.exists(path):
        return []
    stream = store.open(path)
    try:
        content = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return content.splitlines()


def replace_lines(spark: SparkSession, name: str, lines: list[str]) -> None:
    """Write one small file, under a temporary name first; a reader never sees half of it."""
    store, path = _store(spark, name)
    _, hidden = _store(spark, f"{name.rpartition('/')[0]}/_new_{name.rpartition('/')[2]}")
    stream = store.create(hidden, True)
    try:
        stream.write(bytearray(("\n".join(lines) + "\n").encode()))
    finally:
        stream.close()
    if not store.rename(hidden, path):  # stores that do not rename onto a file
        store.delete(path, False)
        store.rename(hidden, path)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder."""
    store, place = _store(spark, path)
    if not store.exists(place):
        return []
    return [f.getPath().getName() for f in store.listStatus(place) if f.isDirectory()]
