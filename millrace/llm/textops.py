"""Shared helpers of the text operators: batches as bytes, word hashes, table access.

Hashes are 64 bits wide and the same in every process, so a task that runs again after a lost
executor gives the same rows.
"""

from __future__ import annotations

import ctypes
import functools
import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are runs of anything but these characters (fixed values of the word rule).
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LOWER_BYTES = LOWER.tobytes()

# Rows that a step takes at once. Spark bounds its batches by 64 MB; steps make several objects
# per row, so they take them in shorter ones.
BATCH_ROWS = 256
# Bytes that the vectorised steps take at once.
BLOCK_BYTES = 1 << 20

_MULTIPLIER = 0x9E3779B97F4A7C15


def prepare(spark: SparkSession) -> None:
    """Make ready for Python code in tasks: send this package to the executors.

    They need not have it installed. No setting of the session is touched.
    """
    context = spark.sparkContext
    if context.applicationId not in _SENT:
        root = Path(__file__).resolve().parent.parent
        target = Path(tempfile.mkdtemp(prefix="millrace-code-")) / f"{root.name}.zip"
        with zipfile.ZipFile(target, "w") as archive:
            for file in sorted(root.rglob("*.py")):
                archive.write(file, file.relative_to(root.parent))
        context.addPyFile(str(target))
        _SENT.add(context.applicationId)


_SENT: set[str] = set()

Batches = Iterator[pa.RecordBatch]


def short(batches: Batches) -> Batches:
    """The same rows in batches of at most BATCH_ROWS."""
    for batch in batches:
        for low in range(0, len(batch), BATCH_ROWS):
            yield batch.slice(low, BATCH_ROWS)


def tidy(function: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """Hand rows on in short batches, and give memory back to the system when done.

    Spark keeps a worker for later tasks, next to a JVM that may need the memory by then.
    """

    @functools.wraps(function)
    def tidied(batches: Batches) -> Batches:
        pa.set_memory_pool(pa.system_memory_pool())  # the default one keeps what batches took
        yield from function(short(batches))
        gc.collect()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    return tidied


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer's file, which is never copied."""
    import public_tokenizers

    return public_tokenizers.path(name)


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of an id as text, modulo a number; 0 where the id is null."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus, F.lit(0))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all their bits."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@functools.lru_cache(maxsize=1)
def byte_codes() -> np.ndarray:
    """A 64-bit value for each byte."""
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER))


@functools.lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd multiplier and of its inverse modulo 2**64."""
    inverse = pow(_MULTIPLIER, -1, 1 << 64)
    steps = np.full(size, _MULTIPLIER, np.uint64), np.full(size, inverse, np.uint64)
    for step in steps:
        step[0] = 1
    return np.cumprod(steps[0]), np.cumprod(steps[1])


def as_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a batch's texts, joined, and their n + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = values.buffers()
    places = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    content = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return content[places[0] : places[-1]], places - places[0]


def blocks(offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about so many bytes; a longer text is a range of its own."""
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = int(np.searchsorted(offsets, offsets[low] + size, "right")) - 1
        high = min(max(high, low + 1), rows)
        yield low, high
        low = high


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of joined texts, and each text's first word number."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~IS_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    starts = np.flatnonzero(inside & (edge[:-1] | ~before))
    ends = np.flatnonzero(inside & (edge[1:] | ~after)) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span."""
    size = 1 << max(16, int(len(data)).bit_length())
    powers, inverses = _powers(size)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(byte_codes()[data] * powers[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverses[starts])
