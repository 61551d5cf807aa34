"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import (
    bpe,
    classifier,
    exact_dedup,
    html,
    langid,
    line_dedup,
    minhash,
    packing,
    quality_rules,
    warc,
)
from millrace.llm.textops import tokenizer_file
from millrace.session import scratch, settings

PROSE = "the cat of the house and the dog in the garden is to be with that one for it as on by"
LONG = " ".join(f"word{i % 5000} and{i}" for i in range(30_000))
LINES = "\n".join(f"{PROSE} number {i}" for i in range(8))

# Extra columns carry names that the operators use themselves.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, row string, n long, "
    "id long, text_hash long, kept string, length long, stay_id long, _text string, rank long"
)
TEXTS = [
    (1, PROSE), (2, PROSE), (3, PROSE + " more"), (4, ""), (5, None), (6, " \t\n "),
    (7, LONG), (8, LINES), (9, "intro line here\n" + LINES), (10, "x"), (11, "é" * 300),
    (None, PROSE), (None, None), (1, PROSE), (8, LINES), (1, "another text under the same id"),
    (12, "a " * 400), (13, "!" * 5000), (14, "\n\n\n"), (15, "1 2 3"), (16, "<|endoftext|>"),
]
LANGS = ["en", "en", "de", None, "en", "en", "en", "en", None]


@pytest.fixture(scope="module")
def documents(spark):
    rows = [
        (i, t, LANGS[k % len(LANGS)], None, None, None, None, 5, None, "yes", 1, 2, "z", None)
        for k, (i, t) in enumerate(TEXTS)
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (2, 0, 0), (2, 1, 0), (None, 1, 1), (3, None, None), (9, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def operators(labels):
    return {
        "packing": lambda d: packing.pack(d, tokenizer_file("byte_bpe_50k.json")),
        "exact": exact_dedup.exact_duplicates,
        "language": langid.identify,
        "quality": quality_rules.quality,
        "classifier": lambda d: classifier.score_quality(d, labels),
        "bpe": lambda d: bpe.encode_documents(d, tokenizer_file("word_bpe_49k.json")),
        "lines": line_dedup.dedup_lines,
        "near": minhash.near_duplicates,
    }


NAMES = sorted(operators(None))


@pytest.mark.parametrize("name", NAMES)
def test_every_row_gets_a_result(documents, labels, name):
    found = operators(labels)[name](documents).collect()
    if name == "packing":
        assert sum(row.start == 0 for row in found) == len(TEXTS)
    else:
        assert len(found) == len(TEXTS)
    ids = sorted({row.doc_id for row in found}, key=str)
    assert ids == sorted({i for i, _ in TEXTS}, key=str)


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(nothing, labels, name):
    assert operators(labels)[name](nothing).collect() == []


@pytest.mark.parametrize("name", NAMES)
def test_all_null(spark, labels, name):
    row = (None,) * len(SCHEMA.split(", "))
    found = operators(labels)[name](spark.createDataFrame([row] * 3, SCHEMA)).collect()
    assert len(found) == 3


def test_exact_copies(documents):
    rows = exact_dedup.exact_duplicates(documents).collect()
    prose = [r for r in rows if r.group_size == 4]
    assert {r.keep_id for r in prose} == {2}
    assert [r.kept for r in sorted(prose, key=lambda r: r.doc_id or 0)] == [False] * 3 + [True]
    empty = [r for r in rows if r.group_size == 3]  # one empty text, two nulls
    assert {(r.doc_id, r.keep_id, r.kept) for r in empty} == {
        (4, 5, False), (5, 5, True), (None, 5, False)
    }


@pytest.mark.parametrize("most", [0, 1 << 20])
def test_exact_copies_of_a_hot_text(spark, monkeypatch, most):
    """A third of all rows have one text; with few repeated fingerprints and with many."""
    monkeypatch.setattr(exact_dedup, "BROADCAST_FINGERPRINTS", most)
    text = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.floor(F.col("id") / 2)))
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), text.alias("text"))
    found = exact_dedup.exact_duplicates(rows)
    assert found.where("kept").count() == rows.select("text").distinct().count()
    hot = found.where("group_size = 1000").collect()
    assert len(hot) == 1000 and {r.keep_id for r in hot} == {2997}


def test_lines_of_a_hot_passage(spark):
    """A passage that a third of all documents share stays once."""
    passage = "\n".join(f"{PROSE} and line {i} of it" for i in range(3))
    text = F.when(F.col("id") % 3 == 0, F.concat_ws("\n", F.concat(F.lit("own "), "id"), F.lit(passage)))
    rows = spark.range(900).select(
        F.col("id").alias("doc_id"), text.otherwise(F.concat(F.lit("other "), "id")).alias("text")
    )
    found = line_dedup.dedup_lines(rows)
    assert {r.doc_id for r in found.where("removed = ''").collect()} == {0} | {i for i in range(900) if i % 3}
    assert {(r.removed, r.kept_lines) for r in found.where("removed <> ''").collect()} == {("1-4", 1)}


def test_near_copies(documents):
    rule = minhash.NearRule(words=3, percent=85)
    rows = minhash.near_duplicates(documents, rule).collect()
    prose = {r.doc_id for r in rows if r.component_id == 1 and r.n_shingles >= 15}
    assert prose == {1, 2, 3, None}
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in rows if r.n_shingles == 0} == {
        (4, 0, 4), (5, 0, 5), (6, 0, 6), (14, 0, 14), (None, 0, None)
    }
    kept = minhash.drop_near_duplicates(documents, rule)
    assert kept.columns == documents.columns
    ids = sorted(row.doc_id for row in kept.collect() if row.doc_id is not None)
    # The row repeated under id 8 stays once; id 1 names two texts that are not alike.
    assert ids == [1, 1, 4, 5, 6, 7, 8, 10, 11, 12, 13, 14, 15, 16]


def test_languages(documents):
    rows = langid.identify(documents).collect()
    blank = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert blank == {4, 5, 6, 13, 14, 15, None}
    assert all(r.score == 0 and r.rejected for r in rows if r.lang_pred == "und")


def test_language_without_labels(documents):
    rows = langid.identify(documents.drop("lang").selectExpr("*", "CAST(NULL AS STRING) lang"))
    assert {r.lang_pred for r in rows.collect()} == {"und"}


def test_documents_stay_without_labels(documents):
    """Nothing can be told, so nothing is rejected."""
    unknown = documents.selectExpr("* EXCEPT (lang)", "CAST(NULL AS STRING) AS lang")
    assert langid.drop_rejected(unknown).count() == documents.count()


def test_classifier_without_metadata(documents, labels):
    """A column that is missing, or no number, counts as missing values."""
    whole = sorted(map(repr, classifier.score_quality(documents.drop("n_chars"), labels).collect()))
    text = documents.selectExpr("* EXCEPT (n_chars)", "'many' AS n_chars")
    assert sorted(map(repr, classifier.score_quality(text, labels).collect())) == whole


def test_classifier_without_labels(documents, labels):
    rows = classifier.score_quality(documents, labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in rows} == {(0.5, 1)}


def test_quality_base(documents):
    rows = {r.doc_id: r for r in quality_rules.quality(documents).collect()}
    assert rows[5].n_words == 0 and rows[5].base_failed and not rows[5].kept
    assert rows[6].n_words == 0 and rows[6].word_chars == 0
    assert rows[12].n_repeat_words == 400 and rows[12].base_failed
    assert rows[13].n_words == 1 and rows[13].word_chars == 5000
    assert rows[14].n_dup_lines == 0
    assert rows[7].n_words == 60_000


def test_repeated_lines(documents):
    rows = line_dedup.dedup_lines(documents).collect()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[8].text == LINES and by_id[8].removed == ""  # both rows of id 8 keep all
    assert by_id[9].kept_lines < by_id[9].n_lines and by_id[9].removed
    assert by_id[5].text is None and by_id[5].n_lines == 0
    assert by_id[4].text == "" and by_id[4].n_lines == 1
    assert by_id[14].text == "\n\n\n"


def test_stages_keep_columns(spark, documents, nothing):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for docs in (documents, nothing):
            assert stage(spark, docs, "").columns == docs.columns, name
            assert stage(spark, docs, "").count() <= docs.count()


def test_whole_pipeline(spark, documents, nothing):
    """Edge cases, clashing names and an empty table through all stages."""
    for docs in (documents, nothing):
        folder = scratch(spark, "pipeline-test")
        docs.write.parquet(f"{folder}/documents.parquet")
        found = corpus_pipeline.run(spark, folder)
        assert found.columns[:2] == ["doc_id", "piece"]
        assert (found.count() > 0) == (docs is documents)


PAGE = "<article><p>" + PROSE + ".</p></article>"
PAGES = [
    (1, "http://a/", PAGE), (2, None, PAGE), (2, None, PAGE), (3, "u\r\nv", None), (4, "", ""),
    (None, None, None), (None, "x", PAGE), (5, "http://b/é", "<p>" + "y" * 200_000), (6, "s", "short"),
    (7, "s", "short"), (8, "http://a/", PAGE),
]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(*page, "extra", 1, b"") for page in PAGES]
    schema = "page_id long, url string, html string, digest string, refers_to long, note binary"
    return spark.createDataFrame(rows, schema)


def test_archive(spark, pages):
    folder = scratch(spark, "warc-test")
    warc.write_archive(pages, folder, roll_bytes=2000)
    rows = warc.read_archive(spark, folder).collect()
    found = sorted(
        ((r.page_id, r.url, r.payload_bytes, r.record_type, r.refers_to) for r in rows), key=str
    )
    size = len(PAGE)
    expected = [
        (1, "http://a/", size, "response", None), (2, None, size, "revisit", 1),
        (2, None, size, "revisit", 1), (3, "u\r\nv", 0, "response", None),
        (4, "", 0, "response", None), (None, None, 0, "response", None),
        (None, "x", size, "revisit", 1), (5, "http://b/é", 200_003, "response", None),
        (6, "s", 5, "response", None), (7, "s", 5, "response", None),
        (8, "http://a/", size, "revisit", 1),
    ]
    assert found == sorted(expected, key=str)
    manifest = spark.read.parquet(f"{folder}/manifest")
    assert manifest.agg({"records": "sum"}).first()[0] == len(PAGES)


@pytest.fixture(scope="module")
def many_pages(spark):
    """2,000 pages; one id and one payload are frequent, ids leave gaps."""
    html = F.when(F.col("id") % 5 == 0, F.repeat(F.lit("the same "), 40)).otherwise(
        F.concat(F.repeat(F.sha2(F.col("id").cast("string"), 256), 12), F.lit("!"))
    )
    page_id = F.when(F.col("id") % 3 == 0, 77).otherwise(F.col("id") * F.col("id"))
    return spark.range(2000).select(page_id.alias("page_id"), F.lit("u").alias("url"), html.alias("html"))


def test_equal_pages_give_equal_archives(spark, many_pages, monkeypatch):
    """Whatever tasks Spark makes of them; every shard is bounded, a repeated id as well."""
    manifests, written = [], []
    for parts, order in (("3", "page_id"), ("7", "html"), ("1", "url")):
        with settings(spark, {"spark.sql.shuffle.partitions": parts}) as own:
            rows = own.createDataFrame(many_pages.orderBy(order).toArrow()).repartition(int(parts))
            folder = scratch(spark, "warc-test")
            warc.write_archive(rows, folder, roll_bytes=20_000, shard_bytes=100_000)
            manifests.append(sorted(spark.read.parquet(f"{folder}/manifest").collect()))
            written.append(folder)
    assert manifests[0] == manifests[1] == manifests[2] and len(manifests[0]) > 15
    shards = {row.file.split("-")[1] for row in manifests[0]}
    assert len(shards) > 10 and max(row.records for row in manifests[0]) < 500
    # Reading makes as many tasks as the files ask for, up to what runs at once or their size asks.
    read = warc.read_archive(spark, written[0])
    per_task = read.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert read.count() == 2000 and len(per_task) == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(warc, "READ_BYTES", sum(row.bytes for row in manifests[0]) // 12)
    tasks = warc.read_archive(spark, written[0]).select(F.spark_partition_id()).distinct().count()
    assert tasks >= 12


def test_files_of_aborted_attempts_go(spark, many_pages):
    folder = scratch(spark, "warc-test")
    place = Path(folder.removeprefix("file:"))
    place.mkdir(parents=True)
    (place / "_temporary-dead").write_bytes(b"half a file")
    (place / "shard-000000-00000.warc.gz").write_bytes(b"from an attempt before")
    warc.write_archive(many_pages, folder)
    assert not list(place.glob("_temporary-*"))
    assert warc.read_archive(spark, folder).count() == 2000


def test_empty_archive(spark, pages):
    folder = scratch(spark, "warc-test")
    warc.write_archive(pages.limit(0), folder)
    assert warc.read_archive(spark, folder).collect() == []


def test_pages(pages):
    rows = html.extract(pages).collect()
    assert len(rows) == len(PAGES)
    texts = {r.page_id: r.text for r in rows}
    assert texts[1] == PROSE + "." and texts[3] == "" and texts[4] == ""
    assert len(texts[5]) == 200_000
    assert html.extract(pages.limit(0)).collect() == []


def test_hot_rows_are_not_paired(spark):
    """A large group of near copies and a common passage: each link once, as a union of texts."""
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(300):
        words = list(base)
        words[i % 100] = f"changed{i}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join([f"own{i}x{j}" for j in range(60)] + base[:60])) for i in range(200)]
    found = minhash.near_duplicates(
        spark.createDataFrame(rows, "doc_id long, text string"),
        minhash.NearRule(words=3, percent=85),
    ).collect()
    groups = {r.doc_id: r.component_id for r in found}
    assert {groups[i] for i in range(300)} == {0}
    assert all(groups[1000 + i] == 1000 + i for i in range(200))
