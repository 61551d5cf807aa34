"""Quality rules by distribution divergence, in DataFrame functions only.

A document's histograms of character classes and of common words are compared with references of
each language by Jensen-Shannon distance, and the nearest language counts. The references are the
histograms of all documents of a language that look like prose, added up in one pass over the
table. Short documents are guarded: their histograms say little, so the limits are wider there.

Defined results
* null text has no words and fails the base rules, and so does any text of fewer than 20 words;
* without any row that names its language, all rows together are the one reference;
* an empty table gives an empty result; repeated rows each get the same result;
* other columns than doc_id, text and lang are not read.

Windows of eight words are compared by a 64-bit hash of 64-bit word hashes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import scratch

LEAST_WORDS = 20
WINDOW = 8
REPEATED_PERCENT = 30
# Largest distances to the nearest language, and the characters and words from which they hold.
# Guard: below them a histogram is noisy, and the limits grow with the inverse root of the size.
CHAR_DISTANCE = 0.20
FULL_CHARS = 600
WORD_DISTANCE = 0.26
FULL_WORDS = 200
# Of the written counts.
ROW_GROUP_BYTES = 8 * 2**20
# Shorter texts do not shape a reference.
GUARD_CHARS = 100
# References that go into one expression; more of them go to the tasks as a row.
LANGUAGES = 64

SPACE = r"[\x20\x09-\x0D]"
# Character classes in the order in which they are taken out of the text.
CHAR_CLASSES = (
    "[a-z]+", r"[\x20\x09-\x0D]+", "[A-Z]+", "[.,;:?'\"()-]+", "[0-9]+", "[#*$%&|<>!]+",
    r"[^\x00-\x7F]+",
)
CAPITALS, SYMBOLS = 2, 5
# Documents with a larger share (percent) of these do not shape a reference.
MOST_SYMBOLS = 1
MOST_CAPITALS = 15
# Common words of some languages.
COMMON = {
    "en": "the of and to in is that was for it with as on be by this are",
    "de": "der die und in den von zu das mit sich des auf für ist im dem ein",
    "fr": "de la le et les des en un du une que est pour qui dans par pas",
    "es": "de la que el en y los se del las un por con no una su para",
}
WORDS = tuple(dict.fromkeys(word for text in COMMON.values() for word in text.split()))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda total, x: total + x)


def word_counts(hits: Column, others: Column) -> Column:
    """Occurrences per common word, from hits that stand between two spaces each; others last."""
    counts = []
    for word in WORDS:
        size = len(word.encode()) + 2
        less = F.octet_length(F.replace(hits, F.lit(f" {word} "), F.lit("")))
        counts.append(((F.octet_length(hits) - less) / size).cast("long"))
    return F.array(*counts, others.cast("long"))


def histograms(documents: DataFrame, *kept: Column) -> DataFrame:
    """Columns kept, with the text as _text and the two histograms chars and words.

    Each step is a projection of its own whose results the next one uses more than once, so
    that nothing is computed twice.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    parts = documents.select(*kept, text.alias("_text"))
    names = parts.columns
    parts = parts.select(*names, F.split(F.lower("_text"), r"[^\p{L}]+").alias("_runs"))
    blanks = (F.get("_runs", F.lit(0)) == "").cast("int") + (
        (F.size("_runs") > 1) & (F.get("_runs", F.size("_runs") - 1) == "")
    ).cast("int")
    parts = parts.select(
        *names,
        (F.size("_runs") - blanks).alias("_all"),
        F.filter("_runs", lambda w: w.isin(*WORDS)).alias("_hits"),
    )
    parts = parts.select(
        *names,
        (F.col("_all") - F.size("_hits")).alias("_others"),
        F.concat(F.lit(" "), F.array_join("_hits", "  "), F.lit(" ")).alias("_joined"),
    )
    counts = word_counts(F.col("_joined"), F.col("_others"))
    parts = parts.select(*names, F.col("_text").alias("_rest"), counts.alias("words"))
    names.append("words")
    lengths = []
    for i, pattern in enumerate(CHAR_CLASSES):
        less = F.regexp_replace("_rest", pattern, "")
        parts = parts.select(
            *names, *lengths, F.char_length("_rest").alias(f"_c{i}"), less.alias("_rest")
        )
        lengths.append(f"_c{i}")
    parts = parts.select(*names, *lengths, F.char_length("_rest").alias(f"_c{len(CHAR_CLASSES)}"))
    lengths.append(f"_c{len(CHAR_CLASSES)}")
    counts = [F.col(a) - F.col(b) for a, b in zip(lengths, lengths[1:], strict=False)]
    counts = [c.cast("long") for c in (*counts, F.col(lengths[-1]))]
    return parts.select(*names, F.array(*counts).alias("chars"))


def ordinary() -> Column:
    """Whether a text's make-up is that of prose, so that it may shape a reference."""
    total = _sum(F.col("chars"))
    return (
        (total >= GUARD_CHARS)
        & (100 * F.col("chars")[SYMBOLS] <= MOST_SYMBOLS * total)
        & (100 * F.col("chars")[CAPITALS] <= MOST_CAPITALS * total)
    )


Reference = tuple[str | None, list[float], list[float]]


SIZES = {"chars": len(CHAR_CLASSES) + 1, "words": len(WORDS) + 1}


def reference_sums(rows: DataFrame) -> DataFrame:
    """Counts of all documents that look like prose, per language, from counted rows.

    Languages without any such document have no reference.
    """
    sums = [
        F.sum(F.col(name)[i]).alias(f"{name}{i}") for name, n in SIZES.items() for i in range(n)
    ]
    return rows.where(ordinary()).groupBy("lang").agg(*sums)


def references(sums: DataFrame) -> list[Reference] | None:
    """Language, shares of character classes, shares of common words; None for many languages."""
    found = sums.limit(LANGUAGES + 1).collect()
    if len(found) > LANGUAGES:
        return None
    named = [row for row in found if row.lang is not None] or found

    def shares(row, name: str) -> list[float]:
        counts = [float(row[f"{name}{i}"] or 0) for i in range(SIZES[name])]
        return [count / max(sum(counts), 1.0) for count in counts]

    return [(row.lang, shares(row, "chars"), shares(row, "words")) for row in named]


def reference_row(sums: DataFrame) -> DataFrame:
    """All references in one row, for many languages: references, with shares and I(shares)."""

    def parts(name: str) -> list[Column]:
        counts = F.array(*(F.col(f"{name}{i}").cast("double") for i in range(SIZES[name])))
        shares = F.transform(counts, lambda x: x / F.greatest(_total(counts), F.lit(1.0)))
        return [shares.alias(name), _total(F.transform(shares, _informed)).alias(f"{name}_own")]

    named = sums.where("lang IS NOT NULL")
    shares = F.struct(*parts("chars"), *parts("words"))
    return named.agg(F.collect_list(shares).alias("references"))


def _informed(share: Column) -> Column:
    return F.when(share > 0, share * F.log2(share)).otherwise(0.0)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def summed(rows: DataFrame, name: str) -> DataFrame:
    """Add what a histogram's distances need and no reference changes: its total and I(shares)."""
    rows = rows.withColumn(f"{name}_total", F.greatest(_sum(F.col(name)), F.lit(1)))
    shares = F.transform(name, lambda x: _informed(x / F.col(f"{name}_total")))
    return rows.withColumn(f"{name}_own", _total(shares))


def distance(name: str, reference: Column, other: Column | float) -> Column:
    """Jensen-Shannon divergence (base 2) of a summed histogram to a reference's shares.

    With I(p) the sum of p log p, it is half of I(p) + I(q) minus I of the mean of both; `other`
    is that of the reference.
    """
    means = F.zip_with(
        F.col(name),
        reference,
        lambda x, y: _informed((x / F.col(f"{name}_total") + y) / 2),
    )
    return F.greatest((F.col(f"{name}_own") + other) / 2 - _total(means), F.lit(0.0))


def nearest(name: str, references: list[list[float]]) -> Column:
    """The distance of a histogram to its nearest reference; 0 where there is none."""
    found = [
        distance(name, F.array(*map(F.lit, shares)), sum(y * math.log2(y) for y in shares if y > 0))
        for shares in references
    ]
    least = F.least(*found) if len(found) > 1 else found[0] if found else F.lit(0.0)
    return F.round(F.sqrt(least), 6)


def nearest_of_many(name: str) -> Column:
    """The same for references in a column."""
    found = F.transform("references", lambda r: distance(name, r[name], r[f"{name}_own"]))
    return F.round(F.sqrt(F.array_min(found)), 6)


def base_counts(documents: DataFrame, *kept: Column) -> DataFrame:
    """Columns kept, with the histograms and the base counts of every whole text."""
    rows = histograms(documents, *kept)
    text = F.col("_text")
    words = F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    lines = F.filter(F.split(text, "\n"), lambda s: s.rlike(f"[^{SPACE[1:-1]}]"))
    names = [c for c in rows.columns if c != "_text"]
    first = rows.select(
        *names,
        F.char_length(F.regexp_replace(text, f"{SPACE}+", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        lines.alias("_lines"),
        hashes.alias("_hashes"),
    )
    n = F.size("_hashes")

    def window(i: Column) -> Column:
        return F.xxhash64(*(F.get("_hashes", i + k) for k in range(WINDOW)))

    windows = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), window))
    names += ["word_chars", "n_symbols"]
    second = first.select(
        *names,
        n.cast("long").alias("n_words"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(windows, F.array().cast("array<long>")).alias("_windows"),
    )
    # Only texts that repeat a window at all need its places.
    placed = F.sort_array(
        F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    names += ["n_words", "n_dup_lines"]
    empty = F.array().cast("array<struct<h:bigint,i:int>>")
    third = second.select(*names, F.when(repeats, placed).otherwise(empty).alias("_placed"))

    def shared(x: Column, k: Column) -> Column:
        before, after = (F.get("_placed", k + step)["h"] == x["h"] for step in (-1, 1))
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    places = F.sort_array(F.transform(F.filter("_placed", shared), lambda x: x["i"]))
    fourth = third.select(*names, "_placed", places.alias("_places"))
    # Each repeated window adds its words up to where the next one begins; the last adds all.
    gains = F.transform(
        "_places", lambda p, k: F.least(F.lit(WINDOW), F.get("_places", k + 1) - p).cast("long")
    )
    return fourth.select(
        *names,
        F.when(F.size("_places") > 0, _sum(gains)).otherwise(F.lit(0)).cast("long").alias(
            "n_repeat_words"
        ),
    )


def _scaled(limit: float, size: Column, full: int) -> Column:
    """A limit that grows for sizes below the full one, as the noise of a histogram does."""
    return limit * F.sqrt(F.greatest(full / size, F.lit(1.0)))


def judge(documents: DataFrame, kept: Column) -> DataFrame:
    """The column kept, with base counts, base_failed, the distances and the verdict kept.

    The counts of all texts are written once; references and verdicts are made from them, by
    expressions on stored columns alone, so that a filter on the verdict costs no more.
    """
    spark = documents.sparkSession
    path = scratch(spark, "quality-counts")
    counted = base_counts(documents, kept, F.col("lang").alias("lang"))
    counted = summed(summed(counted, "chars"), "words")
    # Small row groups: the writer holds one in memory, here with whole texts.
    counted.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    rows = spark.read.parquet(path)
    sums = reference_sums(rows)
    known = references(sums)
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words")
    )
    if known is None:
        # One row of at most a kilobyte per language goes to every task.
        rows = rows.crossJoin(F.broadcast(reference_row(sums)))
        chars, words = nearest_of_many("chars"), nearest_of_many("words")
    else:
        chars = nearest("chars", [shares for _, shares, _ in known])
        words = nearest("words", [shares for _, _, shares in known])
    far = (chars > _scaled(CHAR_DISTANCE, F.col("chars_total"), FULL_CHARS)) | (
        words > _scaled(WORD_DISTANCE, F.col("words_total"), FULL_WORDS)
    )
    return rows.withColumns(
        {
            "char_distance": chars,
            "word_distance": words,
            "base_failed": failed,
            "kept": ~failed & ~far,
        }
    )


RESULT = (
    "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
    "kept", "char_distance", "word_distance",
)


def quality(documents: DataFrame) -> DataFrame:
    """One row per document: RESULT."""
    return judge(documents, F.col("doc_id").cast("long").alias("doc_id")).select(*RESULT)


def drop_low_quality(documents: DataFrame) -> DataFrame:
    """The documents that the rules keep."""
    rows = judge(documents, F.struct("*").alias("row"))
    return rows.where("kept").select("row.*")
