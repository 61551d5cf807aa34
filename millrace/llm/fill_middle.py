"""Fill-in-the-middle documents through content-defined chunks.

A rolling hash over the bytes of a text cuts it into chunks whose boundaries depend on the bytes
near them alone, so a passage that documents share is cut alike in all of them. What a chunk
contributes is a summary: its words, its code points, whether its edges are white space, and
whether it holds a sentinel. Summaries are kept by content: a chunk that was met before is found
by its hash, confirmed byte by byte, and not read again. Summaries of neighbouring chunks combine
to the counts of the document (a word across an edge counts once, a sentinel across an edge is
looked for), and sums over them find the chunk in which a cut falls.

Tokens are words with the white space before them; white space at the end is a token of its own.
A document is cut into prefix, middle and suffix at two tokens drawn from the SHA-256 of its id,
and written as prefix-suffix-middle or suffix-prefix-middle, or left plain.

Defined results
* null text counts as empty; an empty text, and one that holds a sentinel, stays plain;
* a null id draws as an empty one; rows that share an id draw alike, each over its own text;
* cuts fall between code points whatever the text; no length is too long;
* prefix_chars and middle_chars are null for plain documents;
* other columns, whatever their names, are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.textops import as_bytes, blocks, byte_codes, mix, prepare, tidy

# Sentinels, the key of the draws, shares of documents in percent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
KEY = "42:"
TRANSFORMED, SUFFIX_FIRST = 50, 80

WINDOW = 24  # bytes that a boundary depends on
SHIFT = np.uint64(64 - 9)  # a boundary every 2**9 bytes on average
LEAST, MOST = 64, 8192  # bytes of a chunk
CACHE_BYTES = 16 << 20  # content that a task remembers; more only saves time

SENTINEL = re.compile("|".join((PREFIX, SUFFIX, MIDDLE)).encode())
SPACE = re.compile(rb"[\x20\x09-\x0d]")
WORD = re.compile(rb"[^\x20\x09-\x0d]+")
FOLLOWING = bytes(range(0x80, 0xC0))  # bytes of a character after its first


class Summary(NamedTuple):
    """What a chunk adds to its document."""

    words: int
    chars: int
    open_left: bool  # its first byte is within a word
    open_right: bool  # its last byte is
    sentinel: bool


def summarise(chunk: bytes) -> Summary:
    return Summary(
        len(chunk.split()),
        len(chunk.translate(None, FOLLOWING)),
        not SPACE.match(chunk),
        not SPACE.match(chunk, len(chunk) - 1),
        SENTINEL.search(chunk) is not None,
    )


class Summaries:
    """Summaries by content, a bounded number of bytes."""

    def __init__(self, limit: int = CACHE_BYTES):
        self.limit = limit
        self.size = 0
        self.held: dict[bytes, Summary] = {}

    def of(self, chunk: bytes) -> Summary:
        found = self.held.get(chunk)  # equal hash, then equal bytes
        if found is None:
            found = summarise(chunk)
            if self.size + len(chunk) > self.limit:
                self.held.clear()
                self.size = 0
            self.held[chunk] = found
            self.size += len(chunk)
        return found


def boundaries(data: np.ndarray) -> np.ndarray:
    """Places in joined texts, in order, whose window of bytes before them asks for a cut."""
    if len(data) < WINDOW:
        return np.zeros(0, np.int64)
    # The window's hash doubles its span at each step: 24 bytes are 3 spans of 8.
    total, span = byte_codes()[data], 1
    multiplier = 0x9E3779B97F4A7C15
    while span < 8:
        power = np.uint64(pow(multiplier, span, 1 << 64))
        total = total[:-span] * power + total[span:]
        span *= 2
    power = np.uint64(pow(multiplier, 8, 1 << 64))
    whole = (total[:-16] * power + total[8:-8]) * power + total[16:]
    return np.flatnonzero(mix(whole) >> SHIFT == 0) + WINDOW


def chunk_ends(size: int, places: list[int]) -> list[int]:
    """Ends of the chunks of a text: the asked places, not too near and not too far apart."""
    ends, last = [], 0
    for place in [*places, size]:
        while place - last > MOST:
            last += MOST
            ends.append(last)
        if place - last >= LEAST or (place == size and place > last):
            ends.append(place)
            last = place
    return ends


class Document:
    """A text as summaries of its chunks: counts, and the places of cuts."""

    def __init__(self, text: bytes, ends: list[int], summaries: Summaries):
        self.text = text
        self.starts = [0, *ends[:-1]]
        self.parts = [summaries.of(text[a:b]) for a, b in zip(self.starts, ends, strict=False)]
        # Words that start up to and including each chunk; one across an edge started before.
        self.words, before, open_right = [], 0, False
        self.sentinel = False
        for start, part in zip(self.starts, self.parts, strict=False):
            before += part.words - (open_right and part.open_left)
            open_right = part.open_right
            self.words.append(before)
            self.sentinel = (
                self.sentinel
                or part.sentinel
                or SENTINEL.search(text, max(start - 2, 0), start + 2) is not None
            )
        self.tokens = before + (bool(text) and not open_right)

    def cut(self, tokens: int) -> tuple[int, int]:
        """Bytes and code points that so many tokens take."""
        if tokens == 0:
            return 0, 0
        if tokens == self.tokens:
            return len(self.text), sum(part.chars for part in self.parts)
        at = int(np.searchsorted(self.words, tokens))
        wanted = tokens - (self.words[at - 1] if at else 0)
        start = self.starts[at]
        if at and self.parts[at - 1].open_right and self.parts[at].open_left:
            wanted += 1  # the chunk's first word started in an earlier one
        end = [*self.starts, len(self.text)][at + 1]
        for _, found in zip(range(wanted), WORD.finditer(self.text, start, end), strict=False):
            place = found.start()
        space = SPACE.search(self.text, place)
        byte = space.start() if space else len(self.text)
        # The word may end some chunks later.
        last = int(np.searchsorted(self.starts, byte, "right")) - 1
        chars = sum(part.chars for part in self.parts[:last])
        return byte, chars + len(self.text[self.starts[last] : byte].translate(None, FOLLOWING))


def transform(document: Document, draws: list[int]) -> tuple[int, str, int | None, int | None, str]:
    """Tokens, form, code points of prefix and middle, and the output."""
    text, n = document.text, document.tokens
    if not text or document.sentinel or draws[2] % 100 >= TRANSFORMED:
        return n, "plain", None, None, text.decode()
    low, high = sorted(draw % (n + 1) for draw in draws[:2])
    (a, chars_a), (b, chars_b) = document.cut(low), document.cut(high)
    prefix, middle, suffix = (part.decode() for part in (text[:a], text[a:b], text[b:]))
    if draws[3] % 100 < SUFFIX_FIRST:
        form, output = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, output = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return n, form, chars_a, chars_b - chars_a, output


FILLED = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    summaries = Summaries()
    for batch in batches:
        data, offsets = as_bytes(batch.column(1))
        draws = list(zip(*(column.to_pylist() for column in batch.columns[2:]), strict=True))
        rows = []
        for low, high in blocks(offsets):
            first = offsets[low]
            part = data[first : offsets[high]]
            places = boundaries(part)
            whole = part.tobytes()
            for i in range(low, high):
                a, b = int(offsets[i] - first), int(offsets[i + 1] - first)
                # Only windows within this text.
                x, y = np.searchsorted(places, (a + WINDOW, b))
                ends = chunk_ends(b - a, (places[x:y] - a).tolist())
                rows.append(transform(Document(whole[a:b], ends, summaries), draws[i]))
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
        columns = [
            pa.array(column, kind)
            for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)
        ]
        names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)


def fill_middle(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, n, form, prefix_chars, middle_chars, output."""
    prepare(documents.sparkSession)
    drawn = F.sha2(F.concat(F.lit(KEY), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draws = [
        F.conv(F.substring(drawn, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"draw_{k}")
        for k in range(4)
    ]
    rows = documents.select(F.col("doc_id").cast("long"), "text", *draws)
    return rows.mapInArrow(tidy(_fill), FILLED)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from; sentinels stand in it once each."""

    def after(mark: str) -> Column:
        return F.split_part(output, F.lit(mark), F.lit(2))

    def until(part: Column, mark: str) -> Column:
        return F.split_part(part, F.lit(mark), F.lit(1))

    middle = after(MIDDLE)
    psm = F.concat(until(after(PREFIX), SUFFIX), middle, until(after(SUFFIX), MIDDLE))
    spm = F.concat(until(after(PREFIX), MIDDLE), middle, until(after(SUFFIX), PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digests(documents: DataFrame) -> DataFrame:
    """The rows of fill_middle() with SHA-256 of output and of the text rebuilt from it."""
    rows = fill_middle(documents)
    back = restored(F.col("output"), F.col("form"))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"),
    )
