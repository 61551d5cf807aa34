"""Registered text queries against their SQL, or against brute force where SQL has no words."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest

from corpus_pipeline import STAGES
from millrace.llm.catalog import QUERIES
from millrace.llm.oracle import (
    CONVERSATIONS,
    EXACT_DEDUP,
    FILL_MIDDLE,
    LINE_DEDUP,
    WARC,
    minhash,
    quality,
)
from millrace.llm.textops import tokenizer_file

SF = "/root/testdata/sf0.001"
SQL = {
    "op2_exact_dedup": EXACT_DEDUP,
    "op4_quality_rules": quality(),
    "op5_warc": WARC,
    "op9_line_dedup": LINE_DEDUP,
    "op10_minhash": minhash(3, 85),
    "op12_fill_middle": FILL_MIDDLE,
    "op13_conversation_repair": CONVERSATIONS,
}
KINDS = {"VARCHAR": "string", "BIGINT": "bigint", "DOUBLE": "double", "BOOLEAN": "boolean"}


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in sorted(Path(SF).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


@pytest.fixture(scope="module")
def texts(tables):
    return dict(tables.execute('SELECT doc_id, "text" FROM documents').fetchall())


def rows_of(frame, columns):
    return sorted((tuple(row[c] for c in columns) for row in frame.collect()), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, tables, name):
    found = QUERIES[name](spark, SF)
    types = {row[0]: KINDS[row[1]] for row in tables.execute(f"DESCRIBE {SQL[name]}").fetchall()}
    assert dict(found.dtypes) == types
    expected = tables.execute(SQL[name])
    columns = [column[0] for column in expected.description]
    assert rows_of(found, columns) == sorted(expected.fetchall(), key=repr)


def test_quality_measures_every_language(spark, tables):
    """More languages than go into one expression: each has its reference, as in the SQL."""
    from millrace.llm import quality_rules

    many = f"SELECT * REPLACE ('l' || doc_id % 90 AS lang) FROM '{SF}/documents.parquet'"
    with duckdb.connect() as other:
        other.execute(f"CREATE VIEW documents AS {many}")
        expected = other.execute(SQL["op4_quality_rules"])
        columns, rows = [c[0] for c in expected.description], expected.fetchall()
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    documents = documents.selectExpr("doc_id", "text", "concat('l', doc_id % 90) AS lang")
    assert rows_of(quality_rules.quality(documents), columns) == sorted(rows, key=repr)


def test_packing_is_whole_gapless_and_tight(spark, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    rows = QUERIES["op1_best_fit_packing"](spark, SF).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for row in rows:
        pieces[row.doc_id].append(row)
        sequences[row.sequence_id].append(row)
    assert set(pieces) == set(texts)
    for doc_id, text in texts.items():
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        parts = sorted(pieces[doc_id], key=lambda row: row.piece)
        assert [p.piece for p in parts] == list(range(len(parts)))
        assert [p.length for p in parts[1:]] == [2048] * (len(parts) - 1)
        place = 0
        for part in parts:
            assert part.start == place
            assert part.ids_crc32 == zlib.crc32(ids[place : place + part.length].tobytes())
            place += part.length
        assert place == len(ids) and (len(parts) == 1 or len(ids) > 2048)
    for members in sequences.values():
        place = 0
        for row in sorted(members, key=lambda row: row.offset):
            assert row.offset == place
            place += row.length
        assert place <= 2048
    assert len(sequences) <= -(-sum(row.length for row in rows) // 2048) + 1


def test_bpe_equals_the_library(spark, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    rows = QUERIES["op7_bpe"](spark, SF).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_language_is_right_on_held_out_rows(spark, tables):
    known = dict(tables.execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = QUERIES["op3_language_id"](spark, SF).collect()
    assert {row.doc_id for row in rows} == set(known)
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1) for row in rows)
    held = [row for row in rows if row.held_out and known[row.doc_id]]
    assert sum(row.lang_pred == known[row.doc_id] for row in held) >= 0.97 * len(held)
    assert all(0 <= row.score <= 1 for row in rows)


def test_quality_is_right_on_held_out_rows(spark, tables):
    known = dict(tables.execute("SELECT doc_id, quality FROM labels").fetchall())
    rows = QUERIES["op6_quality_classifier"](spark, SF).collect()
    assert all(row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0) for row in rows)
    assert all(row.predicted == int(row.score >= 0.3) for row in rows)
    held = [row for row in rows if row.held_out and row.doc_id in known]
    assert sum(row.predicted == known[row.doc_id] for row in held) >= 0.85 * len(held)


def test_language_predictions_recomputed_one_by_one(spark, texts):
    """From the stored model: subwords by their definition, one sum per language."""
    from millrace.llm import langid
    from millrace.llm.textops import byte_codes, mix

    documents = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(documents)
    found = {row.doc_id: row for row in langid.identify(documents, model).collect()}
    codes = byte_codes().tolist()
    folded = {i: int(langid.FOLDED[i]) for i in range(256)}

    def bucket(gram):
        total = codes[gram[0]]
        for byte in gram[1:]:
            total = (total * 0x9E3779B97F4A7C15 + codes[byte]) % 2**64
        return int(mix(np.array([total], np.uint64))[0]) >> 49

    short = [i for i, text in texts.items() if text is None or len(text) < 1500]
    assert len(short) > 50
    for doc_id in short:
        text = texts[doc_id] or ""
        if not any(c.isalpha() for c in text):
            assert (found[doc_id].lang_pred, found[doc_id].score) == ("und", 0)
            continue
        data = bytes([32, *(folded[b] for b in text.encode()), 32])
        grams = [
            data[i : i + size]
            for size in langid.SIZES
            for i in range(len(data) - size + 1)
            if (32 not in data[i + 1 : i + size - 1] if size > 2 else data[i : i + 2] != b"  ")
        ]
        sums = [math.fsum(float(model.table[bucket(g)][k]) for g in grams) for k in range(len(model.languages))]
        logits = [x / len(grams) / model.temperature for x in sums]
        powers = [math.exp(x - max(logits)) for x in logits]
        best = max(range(len(powers)), key=powers.__getitem__)
        assert found[doc_id].lang_pred == model.languages[best]
        assert found[doc_id].score == pytest.approx(powers[best] / sum(powers), rel=1e-4)


def test_quality_scores_recomputed_pair_by_pair(spark, tables, texts):
    """From the stored machine: every pair of features by itself, without the identity."""
    from millrace.llm import classifier
    from millrace.llm.textops import span_hashes

    documents, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    machine = classifier.fit(documents, labels)
    found = {row.doc_id: row.score for row in classifier.score_quality(documents, labels).collect()}
    sizes = dict(tables.execute("SELECT doc_id, n_chars FROM documents").fetchall())
    short = [i for i, text in texts.items() if text is not None and len(text.split()) < 150]
    assert len(short) > 15
    for doc_id in short:
        data = texts[doc_id].encode()
        words = data.split()
        counts = {}
        for word in words:
            lower = np.frombuffer(bytes(b + 32 if 65 <= b <= 90 else b for b in word), np.uint8)
            name = int(span_hashes(lower, np.array([0]), np.array([len(lower)]))[0]) >> 49
            counts[name] = counts.get(name, 0) + 1
        norm = math.sqrt(sum(counts.values())) or 1.0
        x = {name: math.sqrt(n) / norm for name, n in counts.items()}
        raw = np.frombuffer(data, np.uint8)
        lengths = np.array([len(w) for w in words], np.float32)
        stats = classifier.statistics(raw, lengths, np.array(sorted(counts.values())))
        size = sizes[doc_id]
        n = len(texts[doc_id])
        known = [0, 1, 1] if size is None else [math.log1p(size), 0, min((size + 1) / (n + 1), 10)]
        whole = np.concatenate([stats, np.array(known, np.float32)])
        scaled = np.clip((whole - machine.middle) / machine.spread, -4, 4)
        scaled = scaled / math.sqrt(classifier.STATISTICS + classifier.METADATA)
        x |= {classifier.BUCKETS + k: float(v) for k, v in enumerate(scaled)}
        total = machine.bias + sum(float(machine.weights[i]) * v for i, v in x.items())
        names = sorted(x)
        for a, i in enumerate(names):
            for j in names[a + 1 :]:
                total += float(machine.factors[i] @ machine.factors[j]) * x[i] * x[j]
        expected = 1 / (1 + math.exp(-(machine.slope * total + machine.shift)))
        assert found[doc_id] == pytest.approx(expected, abs=2e-3)


def test_queries_leave_the_session_as_it_is(spark):
    for name in sorted(QUERIES):
        if name == "pipeline":
            continue
        before = dict(spark.conf.getAll)
        QUERIES[name](spark, SF).count()
        assert dict(spark.conf.getAll) == before, name


def test_extraction_keeps_the_article_and_nothing_else(spark, tables):
    import html
    import re

    pages = dict(tables.execute("SELECT page_id, html FROM pages").fetchall())
    for row in QUERIES["op8_html_extraction"](spark, SF).collect():
        page = pages[row.page_id]
        inner = page[page.index("<article>") :].partition("</article>")[0]
        inner = re.sub(r"</?(?:p|h1|br|article)[^>]*>", "\n", inner)
        inner = html.unescape(re.sub(r"<[^>]*>?", "", inner))
        assert row.text.split() == inner.split()
        assert row.n_chars == len(row.text)


def test_whole_passages_go(spark, texts):
    """Runs of lines over 50 words that an earlier document holds, line by line, all go."""
    rows = {row.doc_id: row for row in QUERIES["op9_line_dedup"](spark, SF).collect()}
    lines = {i: (text or "").split("\n") for i, text in texts.items()}
    places, runs, kept = defaultdict(list), 0, set()
    for doc_id in sorted(lines):
        own = lines[doc_id]
        gone = set()
        for part in filter(None, rows[doc_id].removed.split(",")):
            gone |= set(range(*map(int, part.split("-"))))
        assert rows[doc_id].kept_lines == len(own) - len(gone)
        if texts[doc_id] is not None:
            left = [line for i, line in enumerate(own) if i not in gone]
            assert rows[doc_id].text == "\n".join(left)
            # What goes stays at an earlier place.
            kept |= set(left)
            assert {own[i] for i in gone} <= kept
        for i, line in enumerate(own):
            for other, j in places[line]:
                if i and j and own[i - 1] == lines[other][j - 1]:
                    continue
                n = 0
                while own[i + n : i + n + 1] == lines[other][j + n : j + n + 1] != []:
                    n += 1
                if len(" ".join(own[i : i + n]).split()) > 50:
                    runs += 1
                    assert set(range(i, i + n)) <= gone, (doc_id, i, n)
        for j, line in enumerate(own):
            places[line].append((doc_id, j))
    assert runs > 0


def test_pipeline_stages_follow_each_other(spark):
    """Each stage against its operator run alone on what the stage before kept."""
    from millrace.llm import langid, line_dedup, packing, quality_rules
    from millrace.llm.minhash import NearRule, near_duplicates

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [name for name, _ in STAGES]
    assert names == [
        "quality_rules", "language_id", "line_dedup", "minhash_dedup", "best_fit_packing",
    ]
    for name, stage in STAGES:
        kept = stage(spark, docs, SF).persist()
        if name != "best_fit_packing":
            assert kept.columns == docs.columns
        ids = sorted(row[0] for row in kept.select("doc_id").distinct().collect())
        if name == "quality_rules":
            expected = quality_rules.quality(docs).where("kept")
        elif name == "language_id":
            expected = langid.identify(docs).where("NOT rejected")
        elif name == "line_dedup":
            expected = line_dedup.dedup_lines(docs).where("kept_lines > 0")
            clean = {row.doc_id: row.text for row in expected.collect()}
            assert all(clean[row.doc_id] == row.text for row in kept.collect())
            assert all(row.n_chars == len(row.text) for row in kept.collect())
        elif name == "minhash_dedup":
            expected = near_duplicates(docs, NearRule(words=5, percent=80)).where("kept")
        else:
            expected = packing.pack(docs, tokenizer_file("byte_bpe_50k.json"))
        assert ids == sorted(r[0] for r in expected.select("doc_id").distinct().collect()), name
        assert 0 < len(ids) <= docs.count()
        docs = kept


def test_pipeline_query_is_the_last_stage(spark):
    found = QUERIES["pipeline"](spark, SF)
    assert found.columns[:2] == ["doc_id", "piece"]
    assert found.count() > 0
