"""The training-data pipeline over documents: quality rules, language, lines, near copies, packing.

Each stage takes the session, the documents that its predecessor kept, and the table folder, and
returns documents with the same columns; the last one returns the packed pieces. run() writes
every stage's result to the folder in spark.checkpoint.dir and reads it again, so a lost executor
costs at most one stage and lineage stays short.

Defined results: every stage keeps what its operator's docstring says of nulls, empty and repeated
rows; an empty table goes through all stages and gives no pieces. Where no document has a language
to learn from, no document goes for its language.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import langid, line_dedup, minhash, packing, quality_rules
from millrace.llm.textops import table, tokenizer_file
from millrace.session import scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Near copies: shingles of five words, a similarity of 0.8 or more.
NEAR = minhash.NearRule(words=5, percent=80)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.drop_low_quality(docs)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with enough confidence; all, if nothing can be learned."""
    return langid.drop_rejected(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of lines that an earlier one has."""
    return line_dedup.drop_repeated_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return minhash.drop_near_duplicates(docs, NEAR)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their place in sequences."""
    return packing.pack(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("language_id", language),
    ("line_dedup", lines),
    ("minhash_dedup", near_copies),
    ("best_fit_packing", pack),
]

# Language identification and packing are learned or planned, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
