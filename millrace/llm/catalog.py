"""The registered text queries, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    bpe,
    classifier,
    conversation,
    exact_dedup,
    fill_middle,
    html,
    langid,
    line_dedup,
    minhash,
    neighbours,
    oracle,
    packing,
    quality_rules,
    warc,
)
from millrace.llm.textops import table, tokenizer_file
from millrace.session import scratch

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


@query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


@query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents"))


@query
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the archive of all pages and reads it back."""
    folder = scratch(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), folder)
    return warc.read_archive(spark, folder)


@query
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return classifier.score_quality(documents, labels)


@query
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(
        table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json")
    )


@query
def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


# Words of a shingle and similarity in percent, as the query's contract sets them.
NEAR = minhash.NearRule(words=3, percent=85)


@query
def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), NEAR)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_query = F.col("vec_id") % 100 == 0
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), is_query)


@query
def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digests(table(spark, sf_dir, "documents"))


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation.repair_report(table(spark, sf_dir, "conversations"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


ORACLE: dict[str, str] = {
    "op2_exact_dedup": oracle.EXACT_DEDUP,
    "op4_quality_rules": oracle.quality(),
    "op5_warc": oracle.WARC,
    "op9_line_dedup": oracle.LINE_DEDUP,
    "op10_minhash": oracle.minhash(NEAR.words, NEAR.percent),
    "op12_fill_middle": oracle.FILL_MIDDLE,
    "op13_conversation_repair": oracle.CONVERSATIONS,
}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
