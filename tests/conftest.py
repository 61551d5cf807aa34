from __future__ import annotations

import itertools
import os
import sys
import time
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from millrace.schema import RAW_COLUMNS, RAW_SCHEMA  # noqa: E402
from millrace.session import session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    extra = {
        "spark.master": "local[4]",
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
        "spark.sql.maxMetadataStringLength": "2000",
    }
    spark = session("tests", **extra)
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


GOOD = {
    "event_id": "a",
    "event_time": "2026-01-05T10:15:30.123456+00:00",
    "user_id": "1",
    "action": "view",
    "product_id": "17",
    "product_name": "Teapot (blue)",
    "category": "Kitchen",
    "price": None,
    "quantity": None,
    "source": "web",
}


@pytest.fixture(scope="session")
def raw(spark):
    """Raw rows: a good one changed by each given dict."""

    def make(*changes: dict):
        rows = [tuple({**GOOD, **change}[name] for name in RAW_COLUMNS) for change in changes]
        return spark.createDataFrame(rows, RAW_SCHEMA)

    return make


@pytest.fixture
def put_csv(tmp_path):
    """Write one event file into a folder, by hand; each a second later than the one before."""
    folder = tmp_path / "incoming"
    folder.mkdir()
    times = itertools.count(int(time.time()) - 10_000)

    def put(name: str, *changes: dict, header=RAW_COLUMNS) -> str:
        lines = [",".join(header)]
        for change in changes:
            row = {**GOOD, **change}
            lines.append(",".join(row[column] or "" for column in header))
        (folder / name).write_text("\n".join(lines) + "\n")
        os.utime(folder / name, (moment := next(times), moment))
        return str(folder)

    return put
