"""Packing of tokenised documents into sequences by minimum bin slack.

A bin is filled by bitset subset-sum: starting from the longest piece left, a dynamic program
over the lengths that are still available finds the fullest combination that fits, and that
combination is removed. Only how many pieces of each length there are matters for this, so the
plan is made on the histogram of lengths (at most `capacity` entries, whatever the corpus size),
and a combination is taken as often as its lengths allow. Pieces then find their place by their
rank among the pieces of the same length, which Spark computes.

Defined results
* null text counts as empty and gives one piece of the single closing id;
* a document longer than the capacity is cut into pieces of the capacity, the first may be
  shorter; no other is cut;
* repeated rows and null ids are packed like any other row, each once;
* an empty table gives no sequences; other columns are not read.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.textops import prepare, tidy
from millrace.session import scratch

CAPACITY = 2048
CLOSING_ID = 0
# Pieces of one length that are ranked together.
RANK_ROWS = 1_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, place int"


# --- the plan --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Pattern:
    """A combination of lengths, (length, times) from long to short, and how many bins use it."""

    parts: tuple[tuple[int, int], ...]
    bins: int


def fullest(available: dict[int, int], room: int) -> dict[int, int]:
    """The fullest combination of the available lengths that fits: length to times used.

    Bit i of a set tells that sum i can be reached. The sets before each step are kept to walk
    back along the combination found.
    """
    reached, target, steps = 1, 1 << room, []
    for length in sorted(available, reverse=True):
        if length > room:
            continue
        for _ in range(min(available[length], room // length)):
            more = (reached | reached << length) & ((target << 1) - 1)
            if more == reached:
                break
            steps.append((length, reached))
            reached = more
            if reached & target:
                break
        if reached & target:
            break
    total, used = reached.bit_length() - 1, {}
    for length, before in reversed(steps):
        if not before >> total & 1:
            total -= length
            used[length] = used.get(length, 0) + 1
    return used


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Minimum bin slack over a histogram of lengths."""
    left = {length: count for length, count in histogram.items() if count > 0}
    patterns = []
    while left:
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        used = fullest({k: v for k, v in rest.items() if v}, capacity - longest)
        used[longest] = used.get(longest, 0) + 1
        bins = min(left[length] // times for length, times in used.items())
        for length, times in used.items():
            left[length] -= times * bins
            if not left[length]:
                del left[length]
        patterns.append(Pattern(tuple(sorted(used.items(), reverse=True)), bins))
    return patterns


def assignment(patterns: list[Pattern]) -> dict[int, dict[str, np.ndarray]]:
    """For each length, the ranges of ranks: where they begin, first bin, times, first offset."""
    taken: dict[int, int] = {}
    rules: dict[int, list[tuple[int, int, int, int]]] = {}
    first_bin = 0
    for pattern in patterns:
        offset = 0
        for length, times in pattern.parts:
            begin = taken.get(length, 0)
            rules.setdefault(length, []).append((begin, first_bin, times, offset))
            taken[length] = begin + times * pattern.bins
            offset += length * times
        first_bin += pattern.bins
    names = ("begin", "bin", "times", "offset")
    return {
        length: dict(zip(names, np.array(rows, np.int64).T, strict=True))
        for length, rows in rules.items()
    }


# --- tokens ----------------------------------------------------------------------------------


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies, by the rule that defines them."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteTokenizer:
    """The ids of a byte-level vocabulary file; the file decides, tiktoken does the usual texts.

    tiktoken runs the same merges several times faster. Texts with characters whose classes
    could differ between the two libraries' Unicode tables go to the library of the file.
    """

    def __init__(self, path: str):
        import re

        import tiktoken
        from tokenizers import Tokenizer

        self.load = functools.cache(lambda: Tokenizer.from_file(path))
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        alphabet = _byte_alphabet()
        special = {token["content"]: token["id"] for token in content["added_tokens"]}
        ranks = {
            bytes(alphabet[c] for c in token): number
            for token, number in content["model"]["vocab"].items()
            if token not in special
        }
        pattern = (
            r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        )
        self.fast = tiktoken.Encoding(
            "byte-level", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        # Beyond Latin letters and ordinary signs, a special token, or a very long run.
        self.unusual = re.compile(
            r"[^\t-\r -~\xa0-ɏ]|[^\s]{2000}|\s{2000}|"
            + "|".join(re.escape(token) for token in special)
        )

    def ids(self, text: str) -> np.ndarray:
        if self.unusual.search(text):
            found = self.load().encode(text, add_special_tokens=False).ids
        else:
            found = self.fast.encode_ordinary(text)
        return np.array(found, dtype="<u4")


@functools.lru_cache(maxsize=2)
def byte_tokenizer(path: str) -> ByteTokenizer:
    return ByteTokenizer(path)


def cut(size: int, capacity: int) -> list[tuple[int, int]]:
    """Begin and end of the pieces of so many ids."""
    first = size % capacity or min(size, capacity)
    edges = [0, *range(first, size + 1, capacity)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def _tokenise(tokenizer_path: str, capacity: int):
    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = byte_tokenizer(tokenizer_path)
        place = 0  # spreads equal pieces over ranking tasks; kept with the piece once written
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = np.append(tokenizer.ids(text or ""), np.uint32(CLOSING_ID)).astype("<u4")
                for number, (begin, end) in enumerate(cut(len(ids), capacity)):
                    crc = zlib.crc32(ids[begin:end].tobytes())
                    rows.append((doc_id, number, begin, end - begin, crc, place & 0x7FFFFFFF))
                    place += 1
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "place"],
            )

    return tokenise


# --- ranks and places ------------------------------------------------------------------------


def _place(rules: dict[int, dict[str, np.ndarray]]):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            ranks = batch.column("rank").to_numpy()
            bins = np.empty(len(lengths), np.int64)
            offsets = np.empty(len(lengths), np.int64)
            order = np.argsort(lengths, kind="stable")
            edges = np.flatnonzero(np.diff(lengths[order])) + 1
            for rows in np.split(order, edges) if len(order) else []:
                length = int(lengths[rows[0]])
                rule = rules[length]
                at = np.searchsorted(rule["begin"], ranks[rows], "right") - 1
                within = ranks[rows] - rule["begin"][at]
                bins[rows] = rule["bin"][at] + within // rule["times"][at]
                offsets[rows] = rule["offset"][at] + within % rule["times"][at] * length
            kept = [batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(bins), pa.array(offsets)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return place


def pack(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = documents.sparkSession
    prepare(spark)
    path = scratch(spark, "pieces")
    texts = documents.select(F.col("doc_id").cast("long"), "text")
    texts.mapInArrow(tidy(_tokenise(tokenizer_path, capacity)), PIECES).write.parquet(path)
    pieces = spark.read.parquet(path)

    counts = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {row.length: row.n for row in counts.collect()}  # at most `capacity` rows
    rules = assignment(plan(histogram, capacity))

    # Ranks within a length: a frequent length is split over shares, then shares are added up.
    shares = -(-max(histogram.values(), default=0) // RANK_ROWS)
    spread = pieces.withColumn("share", F.col("place") % max(shares, 1))
    sizes = spread.groupBy("length", "share").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select(
        "length", "share", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    # Ties beyond these columns are pieces that are equal in every respect.
    within = Window.partitionBy("length", "share").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = spread.withColumn("rank", F.row_number().over(within) - 1).join(
        firsts, ["length", "share"]
    )
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("first"))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        tidy(_place(rules)),
        "doc_id long, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long",
    )
