"""Repeated passages of lines, through content-defined chunks.

A rolling hash over the hashes of lines decides where chunks end, so the same lines are cut the
same way wherever they stand, whatever was inserted before them. A line of LINE_WORDS words or
more is a chunk of its own; among shorter ones a chunk ends at the least hash of some NEAR_LINES
lines in a row. Lines without a word belong to no boundary.

Chunks that occur more than once anywhere are candidates. Lines around them are compared byte by
byte, and each match is extended over neighbouring equal lines: the shortest runs of more than
PASSAGE_WORDS words that hold a repeated chunk, from every line on and up to every line. Runs
that are equal in all their lines are removed but for the first, and so are repeated chunks of
several lines.

Every repeated run of more than PASSAGE_WORDS words is found. If it has a line of LINE_WORDS
words, that line is a chunk. Otherwise it has 13 lines with a word or more, and the fourth to the
third from the end are cut by nothing outside it: two windows of NEAR_LINES of these have a cut
each, and what is between two cuts next to each other is a chunk in every copy.

Defined results
* lines end at \\n; words are runs of anything but space and \\t to \\r; the text without the
  removed lines keeps the others in order, joined by \\n;
* the first occurrence is the one with the smallest (doc_id, hash of the text, begin, end), null
  ids first; each line removed stays at an earlier place;
* what overlaps the first occurrence in its own text stays;
* null text stays null with 0 lines, empty text is one empty line;
* rows that repeat both id and text are one document: what the first keeps, all keep;
* an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.textops import prepare, tidy
from millrace.session import scratch

# Lines under the rolling hash, its multiplier and modulus; lines of which one ends a chunk.
WINDOW = 2
MULTIPLIER = 31
MODULUS = 1_000_003
NEAR_LINES = 3
# Words of a line that is a chunk of its own.
LINE_WORDS = 5
# Lines of a repeated chunk that is removed whatever its words.
LEAST_LINES = 2
# Runs of lines with more words than this are passages.
PASSAGE_WORDS = 50


def line_hash(line: bytes) -> int:
    return int(hashlib.md5(line, usedforsecurity=False).hexdigest()[:8], 16)


def rolling(hashes: list[int]) -> list[int]:
    """Hash of the last WINDOW lines at each line, from the one before it."""
    found, total, drop = [], 0, MULTIPLIER**WINDOW
    for i, value in enumerate(hashes):
        total = total * MULTIPLIER + value
        if i >= WINDOW:
            total -= hashes[i - WINDOW] * drop
        found.append(total % MODULUS)
    return found


def least_of_some(values: list[int]) -> list[bool]:
    """Which values are the least of some NEAR_LINES in a row; of equal ones the last."""
    found = [False] * len(values)
    for low in range(len(values) - NEAR_LINES + 1):
        near = range(low, low + NEAR_LINES)
        found[min(near, key=lambda i: (values[i], -i))] = True
    return found


def chunks(lines: list[bytes]) -> list[tuple[int, int, int]]:
    """Begin, end and lines with a word of the chunks of a text's lines.

    A chunk begins and ends with a line that has a word.
    """
    words = [len(line.split()) for line in lines]
    worded = [i for i, count in enumerate(words) if count]
    ends = least_of_some(rolling([line_hash(lines[i]) for i in worded]))
    found, begin = [], 0
    for k, i in enumerate(worded):
        last = k + 1 == len(worded)
        if last or ends[k] or words[i] >= LINE_WORDS or words[worded[k + 1]] >= LINE_WORDS:
            found.append((worded[begin], i + 1, k + 1 - begin))
            begin = k + 1
    return found


def passages(words: list[int]) -> set[tuple[int, int]]:
    """Begin and end of the shortest runs with enough words, from each line and up to each.

    They begin and end with a line that has a word.
    """
    worded = [i for i, count in enumerate(words) if count]
    total = [0]
    for i in worded:
        total.append(total[-1] + words[i])
    found = set()
    for k in range(len(worded)):
        end = bisect_right(total, total[k] + PASSAGE_WORDS)
        if end < len(total):
            found.add((worded[k], worded[end - 1] + 1))
        begin = bisect_left(total, total[k + 1] - PASSAGE_WORDS) - 1
        if begin >= 0:
            found.add((worded[begin], worded[k] + 1))
    return found


def around(words: list[int], begin: int, end: int) -> tuple[int, int]:
    """The lines that a shortest run which holds the given ones may reach."""
    total = 0
    while begin > 0 and total <= PASSAGE_WORDS:
        begin -= 1
        total += words[begin]
    total = 0
    while end < len(words) and total <= PASSAGE_WORDS:
        total += words[end]
        end += 1
    return begin, end


def _table(rows: list[tuple], kinds: tuple, names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    arrays = [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


DOC = "doc_id long, text_hash long"
PLACE = ("doc_id", "text_hash", "begin", "end")


def _chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks with a digest of each, and whether they hold several lines."""
    names = ["doc_id", "text_hash", "begin", "end", "several", "digest"]
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary())
    for batch in batches:
        rows = []
        for doc_id, text_hash, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            lines = text.encode().split(b"\n") if text else []
            for begin, end, worded in chunks(lines):
                digest = hashlib.sha256(b"\n".join(lines[begin:end])).digest()[:16]
                rows.append((doc_id, text_hash, begin, end, worded >= LEAST_LINES, digest))
        yield _table(rows, kinds, names)


def _lines_near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines that a match at one of the seeds could reach."""
    names = ["doc_id", "text_hash", "line", "words", "content"]
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string())
    for batch in batches:
        rows = []
        for doc_id, text_hash, text, seeds in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            lines = text.split("\n")
            words = [len(line.encode().split()) for line in lines]
            reach = _apart(around(words, seed["begin"], seed["end"]) for seed in seeds)
            for a, b in reach:
                rows += [(doc_id, text_hash, i, words[i], lines[i]) for i in range(a, b)]
        yield _table(rows, kinds, names)


def matches(lines: list[tuple[int, int, int]], seeds: list[tuple[int, int, bool]]) -> Iterator[tuple]:
    """Begin, end and the line classes of what may be removed.

    lines: number, words and class of lines that stand elsewhere too, in order; seeds: begin, end
    and whether it holds several lines, in order, apart.
    """
    begins = [seed[0] for seed in seeds]
    low = 0
    while low < len(lines):
        high = low + 1
        while high < len(lines) and lines[high][0] == lines[high - 1][0] + 1:
            high += 1
        first, run = lines[low][0], lines[low:high]
        spans = {(first + a, first + b) for a, b in passages([words for _, words, _ in run])}
        for begin, end in spans:
            at = bisect_left(begins, begin)
            if at < len(seeds) and seeds[at][1] <= end:
                yield begin, end, [kind for _, _, kind in run[begin - first : end - first]]
        for begin, end, several in seeds[bisect_left(begins, first) :]:
            if begin >= first + len(run):
                break
            if several and end <= first + len(run) and (begin, end) not in spans:
                yield begin, end, [kind for _, _, kind in run[begin - first : end - first]]
        low = high


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "text_hash", "begin", "end", "classes"]
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()))
    for batch in batches:
        rows = []
        for doc_id, text_hash, lines, seeds in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            held = [(x["line"], x["words"], x["class"]) for x in lines]
            known = [(x["begin"], x["end"], x["several"]) for x in seeds]
            rows += [(doc_id, text_hash, *found) for found in matches(held, known)]
        yield _table(rows, kinds, names)


def _apart(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same lines in ranges that neither overlap nor touch."""
    found: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if found and begin <= found[-1][1]:
            found[-1] = (found[-1][0], max(end, found[-1][1]))
        else:
            found.append((begin, end))
    return found


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, totals, left, spans = [], [], [], []
        lists = [c.to_pylist() for c in batch.columns[-2:]]
        for text, removed in zip(*lists, strict=True):
            if text is None:
                texts.append(None), totals.append(0), left.append(0), spans.append("")
                continue
            lines = text.split("\n")
            gone = _apart((span["begin"], span["end"]) for span in removed or ())
            edges = [0, *(edge for span in gone for edge in span), len(lines)]
            kept = [
                line for a, b in zip(edges[::2], edges[1::2], strict=True) for line in lines[a:b]
            ]
            texts.append("\n".join(kept))
            totals.append(len(lines))
            left.append(len(kept))
            spans.append(",".join(f"{a}-{b}" for a, b in gone))
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:-2],
                pa.array(texts, pa.string()),
                pa.array(totals, pa.int64()),
                pa.array(left, pa.int64()),
                pa.array(spans, pa.string()),
            ],
            names=[*batch.schema.names[:-2], "new_text", "n_lines", "kept_lines", "removed"],
        )


def _kept(rows: DataFrame, name: str) -> DataFrame:
    path = scratch(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def _by_document(rows: DataFrame, *names: str) -> DataFrame:
    """Rows of a document as an array in order, repeated ones once."""
    whole = F.array_sort(F.collect_set(F.struct(*names)))
    return rows.groupBy("doc_id", "text_hash").agg(whole.alias("held"))


def _same(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of the left with what the right holds of their document."""
    named = right.withColumnsRenamed({"doc_id": "own_id", "text_hash": "own_hash"})
    return left.join(named, F.expr("doc_id <=> own_id AND text_hash = own_hash"))


def repeated_spans(texts: DataFrame) -> DataFrame:
    """Lines to remove: doc_id, text_hash, begin and end, from (doc_id, text_hash, text)."""
    kinds = f"{DOC}, begin int, end int, several boolean, digest binary"
    found = _kept(texts.mapInArrow(tidy(_chunk), kinds), "chunks")
    # Digests alone are counted; a frequent one is summed up before the shuffle. Here and below
    # counting and join stand apart, so that Spark may split what very many documents share.
    often = found.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    often = _kept(often.select("digest"), "repeated-chunks")
    seeds = _by_document(found.join(often, "digest"), "begin", "end", "several")
    seeds = _kept(seeds.withColumnRenamed("held", "seeds"), "seeds")
    # Byte comparison: lines with one content are one class.
    held = _same(texts, seeds).select("doc_id", "text_hash", "text", "seeds")
    lines = held.mapInArrow(tidy(_lines_near), f"{DOC}, line int, words int, content string")
    lines = _kept(lines, "lines")
    classes = lines.groupBy("content").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    classes = _kept(classes.select("content", F.monotonically_increasing_id().alias("class")), "classes")
    shared = _by_document(lines.join(classes, "content"), "line", "words", "class")
    both = _same(shared.withColumnRenamed("held", "lines"), seeds)
    both = both.select("doc_id", "text_hash", "lines", "seeds")
    spans = both.mapInArrow(tidy(_match), f"{DOC}, begin int, end int, classes array<long>")
    spans = _kept(spans.select("classes", F.struct(*PLACE).alias("place")), "matches")
    groups = spans.groupBy("classes").agg(F.min("place").alias("first"), F.max("place").alias("last"))
    firsts = _kept(groups.where("first < last").select("classes", "first"), "first-matches")
    joined = spans.join(firsts, "classes")
    elsewhere = ~(
        F.col("place.doc_id").eqNullSafe(F.col("first.doc_id"))
        & (F.col("place.text_hash") == F.col("first.text_hash"))
        & (F.col("place.begin") < F.col("first.end"))
    )
    return joined.where(elsewhere).select("place.*")


def _cleaned(documents: DataFrame) -> DataFrame:
    """Each row in one column, with its text without what is repeated and the line counts."""
    prepare(documents.sparkSession)
    # Whole rows in one column, so that no name of theirs can clash.
    rows = documents.select(
        F.struct("*").alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.col("text").alias("text"),
    )
    gone = _by_document(repeated_spans(rows.select("doc_id", "text_hash", "text")), "begin", "end")
    same = rows["doc_id"].eqNullSafe(gone["doc_id"]) & (rows["text_hash"] == gone["text_hash"])
    joined = rows.join(gone, same, "left").select("row", "text", "held")
    schema = joined.select("row").schema.add("new_text", "string").add("n_lines", "long")
    schema = schema.add("kept_lines", "long").add("removed", "string")
    return joined.mapInArrow(tidy(_without), schema)


def dedup_lines(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, text without what is repeated, n_lines, kept_lines, removed.

    removed lists the line ranges taken out, as begin-end from 0 without the end.
    """
    rows = _cleaned(documents)
    return rows.select(
        F.col("row.doc_id").cast("long").alias("doc_id"),
        F.col("new_text").alias("text"),
        "n_lines",
        "kept_lines",
        "removed",
    )


def drop_repeated_lines(documents: DataFrame) -> DataFrame:
    """The documents with their texts cleaned and n_chars counted anew.

    A document of which every line was removed repeats others wholly and goes.
    """
    rows = _cleaned(documents).where("kept_lines > 0 OR n_lines = 0")
    row = F.col("row").withField("text", F.col("new_text"))
    if "n_chars" in documents.columns:
        count = F.char_length("new_text").cast(documents.schema["n_chars"].dataType)
        row = row.withField("n_chars", count)
    return rows.select(row.alias("row")).select("row.*")
