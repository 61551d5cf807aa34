"""The methods of the text operators, part by part, against plain definitions."""

from __future__ import annotations

import math
import random
import string
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import bpe, classifier, html, langid, line_dedup, minhash, packing, warc
from millrace.llm.exact_dedup import CountingQuotientFilter
from millrace.llm.textops import as_bytes, span_hashes, tokenizer_file, word_spans

WORDS = st.lists(st.text(st.sampled_from(string.ascii_letters + "éüñ'!7 "), max_size=12), max_size=30)


# --- packing ---------------------------------------------------------------------------------


@given(st.dictionaries(st.integers(1, 60), st.integers(1, 9), max_size=8), st.integers(1, 60))
@settings(max_examples=60, deadline=None)
def test_fullest_combination(available, room):
    sums = {0}
    for length, count in available.items():
        sums = {s + length * k for s in sums for k in range(count + 1) if s + length * k <= room}
    used = packing.fullest(available, room)
    assert sum(length * times for length, times in used.items()) == max(sums)
    assert all(times <= available[length] for length, times in used.items())


@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=20))
@settings(max_examples=60, deadline=None)
def test_plan_uses_every_piece_once(histogram):
    patterns = packing.plan(histogram, 64)
    used: dict[int, int] = {}
    for pattern in patterns:
        assert sum(length * times for length, times in pattern.parts) <= 64
        for length, times in pattern.parts:
            used[length] = used.get(length, 0) + times * pattern.bins
    assert used == histogram


def test_pieces_of_a_long_document():
    assert packing.cut(5, 4) == [(0, 1), (1, 5)]
    assert packing.cut(8, 4) == [(0, 4), (4, 8)]
    assert packing.cut(3, 4) == [(0, 3)]


@pytest.mark.parametrize(
    "text", ["", "a", "x" * 5000, " " * 3000 + "y", "<|endoftext|> z", "日本語 ١٢٣", "a\x1cb\x85c", "'s it's"]
)
def test_fast_and_exact_tokens_agree(text):
    tool = packing.byte_tokenizer(tokenizer_file("byte_bpe_50k.json"))
    assert tool.ids(text).tolist() == tool.load().encode(text, add_special_tokens=False).ids


# --- counting quotient filter ----------------------------------------------------------------


@given(st.lists(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 20), max_size=40), max_size=5))
@settings(max_examples=60, deadline=None)
def test_filters_merge_without_loss(parts):
    arrays = [np.array(part, np.uint64) for part in parts]
    filters = [CountingQuotientFilter.of(a) for a in arrays]
    if not filters:
        return
    merged = CountingQuotientFilter.merge(filters)
    whole = np.concatenate(arrays)
    values, counts = np.unique(whole, return_counts=True)
    assert merged.fingerprints().tolist() == values.tolist()
    assert merged.counts.tolist() == counts.tolist()
    assert merged.repeated().tolist() == values[counts > 1].tolist()
    segments = list(merged.segments(7)) if len(whole) else []
    assert sum(len(s[3]) // 4 for s in segments) == len(values)


# --- byte-pair encoding ----------------------------------------------------------------------


@pytest.fixture(scope="module")
def word_tools():
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    return bpe.Encoder(path, remembered=50), Tokenizer.from_file(path)


def check_text(tools, text):
    tool, library = tools
    ids = library.encode(text, add_special_tokens=False).ids
    coded, decoded = next(tool.encode([text]))
    assert np.frombuffer(coded, "<u4").tolist() == ids
    assert decoded == library.decode(ids, skip_special_tokens=False)


@given(WORDS)
@settings(max_examples=60, deadline=None)
def test_encoding_equals_library(word_tools, words):
    check_text(word_tools, " ".join(words))


@pytest.mark.parametrize(
    "text",
    [
        "", " ", "aaaa" * 500, "ΣΑΣ Σ", "İstanbul", "é é", "<|startoftext|>hello<|endoftext|>",
        "<|endoftext|>", "日本語 テキスト", "١٢٣ 456", "a\x1cb\x85c\xa0d", "DON'T we'll", "🙂" * 40,
        "<|endoftext|><|endoftext|> x", "\x00\x01", "ﬁne ßtraße", "x" * 64, "y" * 65,
    ],
)
def test_unusual_texts_equal_library(word_tools, text):
    check_text(word_tools, text)


def test_long_and_short_trees_agree(word_tools):
    vocabulary = word_tools[0].vocabulary
    rng = random.Random(3)
    words = [bytes(rng.choices(b"abcdeinrst\xc3\xa9", k=rng.randint(1, 40))) for _ in range(200)]
    short = []
    for word in words:
        short += bpe.encode_short([word], vocabulary)
    assert short == [bpe.encode_long(word, vocabulary) for word in words]


# --- MinHash ---------------------------------------------------------------------------------


def test_signature_is_circulant():
    rule = minhash.NearRule(words=3, percent=85, bands=4, rows=5)
    scatter, _ = minhash.permutations(rule.seed, rule.size)
    rng = np.random.default_rng(rule.seed)
    size = 1 << minhash.UNIVERSE_BITS
    assert sorted(scatter.tolist()) == list(range(size))
    rng.permutation(size)
    values = rng.permutation(size)
    shingles = np.arange(50, dtype=np.uint64) * np.uint64(7919)
    places = scatter[(shingles % np.uint64(size)).astype(int)].astype(int)
    expected = [values[(places + k) % size].min() for k in range(rule.size)]
    assert minhash.signature(shingles, rule).tolist() == expected


def test_signatures_estimate_similarity():
    rule = minhash.NearRule(words=3, percent=85)
    rng = np.random.default_rng(1)
    shared = rng.integers(0, 2**63, 850).astype(np.uint64)
    own = [rng.integers(0, 2**63, 75).astype(np.uint64) for _ in range(2)]
    a, b = (minhash.signature(np.concatenate([shared, o]), rule) for o in own)
    assert abs((a == b).mean() - 0.85) < 0.12


def test_short_texts_are_one_shingle():
    assert minhash.shingle_set("One two", 3) == {(b"one", b"two")}
    assert minhash.shingle_set(" \t\n", 3) == set()
    assert len(minhash.shingle_set("a b c d a b c", 3)) == 4
    assert minhash.shingle_set("ÀB c\x0bd", 2) == {("Àb".encode(), b"c"), (b"c", b"d")}


def test_components_equal_union_find(spark):
    from millrace.llm.components import components

    rng = random.Random(5)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(150)]
    pairs += [(i, i + 1) for i in range(1000, 1300)] + [(7, 7), (2000, 2001), (2001, 2000)]
    parent = {x: x for pair in pairs for x in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[root(a)] = root(b)
    links = spark.createDataFrame(pairs, "a long, b long")
    found = {row.node: row.component for row in components(links).collect()}
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert set(found) == linked
    for x, y in combinations(sorted(linked), 2):
        assert (found[x] == found[y]) == (root(x) == root(y))


def similarity(a: set, b: set) -> float:
    return len(a & b) / len(a | b)


@pytest.mark.parametrize("percent", (70, 85, 93))
def test_prefixes_lose_no_pair(spark, percent):
    """Against all pairs: sets around the limit, with common passages and of many sizes."""
    from millrace.llm.prefixes import candidate_pairs

    rng = random.Random(percent)
    common, sets = list(range(60)), []
    for i in range(150):
        base = common if i % 3 else [1000 + x for x in range(rng.choice((8, 20, 90)))]
        kept = [x for x in base if rng.random() > (1 - percent / 100) * rng.random()]
        sets.append(set(kept) | {10_000 * (i + 1) + x for x in range(rng.randrange(6))})
    rows = [(i, i % 2, len(s), sorted(s)) for i, s in enumerate(sets)]
    frame = spark.createDataFrame(rows, "id long, component long, n long, members array<long>")
    found = candidate_pairs(frame, percent, minhash._kept).collect()
    pairs = {(row.a, row.b) for row in found}
    assert len(pairs) == len(found) and all(a < b and (a - b) % 2 for a, b in pairs)
    near = {
        (a, b)
        for a, b in combinations(range(len(sets)), 2)
        if (a - b) % 2 and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    }
    assert len(near) > 20 and near <= pairs


def test_later_turns_meet_several_centers(spark):
    """One bucket of 256 classes: with one center for all, a bad one would leave all links open."""
    rows = [(1, i, 256, 1000 - i, i) for i in range(256)]
    bucket = spark.createDataFrame(rows, "key long, id long, size long, weight long, component long")
    pairs = {turn: {(r.a, r.b) for r in minhash._stars(bucket, turn).collect()} for turn in (0, 1, 2)}
    assert pairs[0] == {(0, i) for i in range(1, 256)}
    for turn in (1, 2):
        centers = {a for a, _ in pairs[turn]}
        assert 8 <= len(centers) <= 16 and len(pairs[turn]) == 256 - len(centers)
    assert pairs[1] != pairs[2]


def test_classes_take_few_centers(spark):
    """Many buckets in common, some small: a class takes those centers it shares most with."""
    rows = [(key, i, 64, (i * 37) % 101, i) for key in range(40) for i in range(key, key + 64)]
    bucket = spark.createDataFrame(rows, "key long, id long, size long, weight long, component long")
    pairs = minhash._stars(bucket, 1).distinct().count()
    assert 0 < pairs <= minhash.CENTERS * len({row[1] for row in rows})


def test_rows_move_once_for_join_and_repeats(spark):
    """The rows that stay are long: one exchange serves the join and the repeated rows."""
    from millrace.session import settings

    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text), (1, text), (2, text), (None, "a b c d e f"), (None, "a b c d e f"), (0, "x y z"), (3, None)]
    plain = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    with settings(spark, plain) as own:
        documents = own.createDataFrame(rows, "doc_id long, text string")
        kept = minhash.drop_near_duplicates(documents)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        found = kept.collect()
    assert "SortMergeJoin" in plan and "Exchange" not in plan.split("SortMergeJoin")[0]
    assert {tuple(row) for row in found} == {(1, text), (None, "a b c d e f"), (0, "x y z"), (3, None)}
    assert len(found) == 4


def test_groups_just_below_the_limit_are_not_paired(spark):
    """A hot group of texts that differ a little too much, with a few links in it."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(250):
        words = list(base)
        for place in rng.sample(range(1, 199, 3), 4):  # 12 of 198 shingles of its own
            words[place] = f"own{i}x{place}"
        rows.append((i, " ".join(words)))
    linked = [(1000 + i, text.replace("w150", f"new{i}")) for i, (_, text) in enumerate(rows[:10])]
    documents = spark.createDataFrame(rows + linked, "doc_id long, text string")
    rule = minhash.NearRule(words=3, percent=85)
    sets = {i: minhash.shingle_set(text, 3) for i, text in rows + linked}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    close = []
    for a, b in combinations(sets, 2):
        if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
        else:
            close.append(similarity(sets[a], sets[b]) > 0.75)
    found = minhash.near_duplicates(documents, rule).collect()
    assert {row.doc_id: row.component_id for row in found} == {i: root(i) for i in sets}
    assert sum(close) > 20_000 and len({root(i) for i in sets}) > 200


# --- words and hashes ------------------------------------------------------------------------


@given(st.lists(st.text(st.sampled_from("ab é\t\n\x0b\x0c\r\x85 "), max_size=15), max_size=6))
@settings(max_examples=60, deadline=None)
def test_word_spans(texts):
    import pyarrow as pa

    data, offsets = as_bytes(pa.array(texts, pa.string()))
    starts, ends, first = word_spans(data, offsets)
    words = [bytes(data[a:b]) for a, b in zip(starts, ends, strict=True)]
    expected = [text.encode().split() for text in texts]
    assert words == [word for part in expected for word in part]
    assert np.diff(first).tolist() == [len(part) for part in expected]
    hashes = span_hashes(data, starts, ends).tolist()
    assert len(set(zip(words, hashes, strict=True))) == len(set(words)) == len(set(hashes))


# --- line chunks -----------------------------------------------------------------------------


def test_rolling_hash_equals_its_definition():
    hashes = [line_dedup.line_hash(str(i).encode()) for i in range(20)]
    for i, value in enumerate(line_dedup.rolling(hashes)):
        window = hashes[max(0, i - line_dedup.WINDOW + 1) : i + 1]
        total = sum(h * line_dedup.MULTIPLIER**k for k, h in enumerate(reversed(window)))
        assert value == total % line_dedup.MODULUS


LINE = st.sampled_from([b"a", b"b c", b"d", b"", b" ", b"e f g", b"h i j k", b"one two three four five six"])


@given(st.lists(LINE, max_size=40))
@settings(max_examples=80, deadline=None)
def test_chunks_hold_every_line_with_a_word_once(lines):
    parts = line_dedup.chunks(lines)
    held = [i for a, b, _ in parts for i in range(a, b) if lines[i].split()]
    assert held == [i for i, line in enumerate(lines) if line.split()]
    for begin, end, worded in parts:
        assert lines[begin].split() and lines[end - 1].split()
        assert worded == sum(bool(line.split()) for line in lines[begin:end])
        assert worded == 1 or all(len(line.split()) < 5 for line in lines[begin:end])


SHORT = st.sampled_from([b"a", b"b c", b"", b"e f g", b"h i j k", b"l m n o", b"p q r s", b"t u v"])
RUNS = st.one_of(
    st.lists(LINE, min_size=8, max_size=60), st.lists(SHORT, min_size=18, max_size=40),
    st.lists(st.sampled_from([b"a b c d", b"e f g h"]), min_size=13, max_size=20),
)


@given(RUNS, *[st.lists(LINE, max_size=5)] * 4)
@settings(max_examples=500, deadline=None)
def test_every_repeated_passage_holds_a_chunk_in_all_copies(run, a, b, c, d):
    """Whatever stands around it: so no passage is missed."""
    if sum(len(line.split()) for line in run) <= line_dedup.PASSAGE_WORDS:
        return
    inside = []
    for head, end in ((a, b), (c, d)):
        parts = line_dedup.chunks([*head, *run, *end])
        low, high = len(head), len(head) + len(run)
        inside.append({(x - low, y - low) for x, y, _ in parts if low <= x and y <= high})
    assert inside[0] & inside[1]


@given(st.lists(st.integers(0, 30), max_size=25))
@settings(max_examples=100, deadline=None)
def test_passages_are_the_shortest_runs(words):
    n = len(words)
    enough = {
        (i, j)
        for i in range(n)
        for j in range(i + 1, n + 1)
        if sum(words[i:j]) > line_dedup.PASSAGE_WORDS and words[i] and words[j - 1]
    }
    forward = {min((i, j) for i, j in enough if i == x) for x in {i for i, _ in enough}}
    back = {max((i, j) for i, j in enough if j == y) for y in {j for _, j in enough}}
    assert line_dedup.passages(words) == forward | back
    for i, j in enough:  # longer runs are unions of them
        covered = {x for a, b in forward | back if i <= a and b <= j for x in range(a, b)}
        assert covered == set(range(i, j))


# --- factorisation machine, language model ---------------------------------------------------


def test_sum_of_squares_identity():
    rng = np.random.default_rng(2)
    size = classifier.SIZE
    machine = classifier.FactorisationMachine(
        0.3, rng.normal(size=size), rng.normal(size=(size, 4)), np.zeros(1), np.ones(1)
    )
    at, x = np.array([3, 17, 90, 1000]), rng.normal(size=4)
    pairs = sum(
        machine.factors[at[i]] @ machine.factors[at[j]] * x[i] * x[j]
        for i, j in combinations(range(4), 2)
    )
    expected = 0.3 + machine.weights[at] @ x + pairs
    assert math.isclose(machine.raw(at, x)[0], expected, rel_tol=1e-9)


def test_folded_table_is_the_mean_embedding():
    text = np.frombuffer("Ein kleines Haus, 12 Türen.".encode(), np.uint8)
    rng = np.random.default_rng(4)
    embeddings = rng.normal(size=(langid.BUCKETS, 5))
    output = rng.normal(size=(5, 3))
    model = langid.LanguageModel(["a", "b", "c"], embeddings @ output)
    expected = embeddings[langid.subwords(text)].mean(0) @ output
    assert np.allclose(model.logits(text), expected)


def test_subwords_stay_within_words():
    one, two = (langid.subwords(np.frombuffer(t, np.uint8)) for t in (b"ab cd", b"ab  CD"))
    assert sorted(one.tolist()) == sorted(two.tolist())
    assert len(langid.subwords(np.frombuffer(b"a", np.uint8))) > 0


# --- WARC ------------------------------------------------------------------------------------


def test_record_round_trip():
    import io

    urls = [None, "", "http://a.b/c?d=é\r\nX-Evil: 1", "http://x/" + "y" * 3000]
    for url in urls:
        for payload, target in ((b"", None), (b"<p>\r\n\r\n</p>\x00", None), (b"z" * 200, 4)):
            content = warc.record(9, url, payload, target)
            (found,) = warc.records(io.BytesIO(content))
            page_id, read, size, _, kind, refers_to = warc.parsed(*found)
            assert (page_id, read, size, refers_to) == (9, url, len(payload), target)
            assert kind == ("revisit" if target else "response")


def test_damage_is_noticed():
    import io

    content = bytearray(warc.record(1, "u", b"a" * 50, None))
    content[-10] ^= 1
    (found,) = warc.records(io.BytesIO(bytes(content)))
    with pytest.raises(ValueError):
        warc.parsed(*found)
    with pytest.raises(ValueError):
        list(warc.records(io.BytesIO(bytes(content[:-20]))))


# --- HTML ------------------------------------------------------------------------------------

LONG = "A sentence with words, commas, and a full stop. " * 6


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("no tags at all", "no tags at all"),
        (f"<nav><a href=x>Home</a></nav><article><h1>T</h1><p>{LONG}<p>Short.</article>",
         f"T\n{LONG.strip()}\nShort."),
        (f"<body><div class='menu'>One Two</div><div id=main><p>{LONG}</p><p>{LONG}</p></div>"
         "<div class=footer>c</div>", f"{LONG.strip()}\n{LONG.strip()}"),
        (f"<article><p>a&amp;b &lt;c&gt; {LONG}</p><div class='comments'><p>{LONG}</p></div>",
         f"a&b <c> {LONG.strip()}"),
        ("<article><p>one <b>two</b>\n three<br>four</p><script>var x='<p>no</p>'</script>"
         "<style>p{}</style><!-- <p>no</p> --><form>no</form></article>", "one two three four"),
        (f"<main><p>{LONG}</p><ul><li>x<li>y</ul><table><tr><td>1<td>2</table></main>",
         f"{LONG.strip()}\nx\ny\n1 2"),
        (f"<article><p>{LONG}</p><p>cut off <a href='/unclosed", f"{LONG.strip()}\ncut off"),
        (f"<article><p>{LONG}<!-- never closed <p>no</p>", LONG.strip()),
        ("<script>only code", ""),
    ],
)
def test_main_text(page, text):
    assert html.main_text(page) == text


LINKS = "<div><ul>" + "".join(f"<li><a href=/{i}>Other page {i}</a>" for i in range(6)) + "</ul></div>"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        # Links without a label within <main>.
        (f"<main><h1>T</h1>{LINKS}<p>{LONG}</p>{LINKS}</main>", f"T\n{LONG.strip()}"),
        # A heading that is a link, and a paragraph with links, are content.
        (f"<main><h1><a href=x>T</a></h1><p>{LONG}<a href=y>more</a></p></main>",
         f"T\n{LONG.strip()} more"),
        # No article is marked.
        (f"<div>{LINKS}<div><p>{LONG}</p><p>{LONG}</p></div>{LINKS}</div>",
         f"{LONG.strip()}\n{LONG.strip()}"),
        # An article far shorter than the rest.
        (f"<article><p>Short news</p></article><div class=comments>{f'<p>{LONG * 9}</p>' * 9}</div>",
         "Short news"),
        (f"<article><p>Short news</p></article><div class=body>{f'<p>{LONG * 9}</p>' * 2}</div>",
         "\n".join(["Short news", *[(LONG * 9).strip()] * 2])),
        # Several articles: equal ones stay, teasers go.
        (f"<article><p>{LONG}</p></article><article><p>{LONG}</p></article>"
         "<article><p>Read on</p></article>", f"{LONG.strip()}\n{LONG.strip()}"),
    ],
)
def test_scores_choose_the_content(page, text):
    assert html.main_text(page) == text


SOURCES = "<ul><li><a href=/1>Smith, On words and lines</a><li><a href=/2>Jones, Pages</a></ul>"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        # A paragraph that is one link, and a list of linked sources.
        (f"<article><p>{LONG}</p><p><a href=/r>Read the full report of it here</a></p><p>{LONG}</p></article>",
         f"{LONG.strip()}\nRead the full report of it here\n{LONG.strip()}"),
        (f"<article><p>{LONG}</p>{SOURCES}</article>",
         f"{LONG.strip()}\nSmith, On words and lines\nJones, Pages"),
        # Many, which read as sentences; and short ones in a row, which do not.
        ("<article><p>" + LONG + "</p><ul>" + "".join(f"<li><a>Source {i}. Its title, its year.</a>" for i in range(5))
         + "</ul></article>", LONG.strip() + "".join(f"\nSource {i}. Its title, its year." for i in range(5))),
        (f"<article><p>{LONG}</p>{LINKS}</article>", LONG.strip()),
    ],
)
def test_linked_blocks_of_an_article(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize("tag", ["div", "nav", "b", "p", "ul"])
def test_deep_nesting_takes_little_memory(tag):
    import tracemalloc

    page = f"<article><p>{LONG}</p></article>" + f"<{tag}>" * 40_000 + "deep" + f"</{tag}></i>" * 40_000
    tracemalloc.start()
    found = html.main_text(page)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.startswith(LONG.strip()) and most < 60 * 2**20


@pytest.mark.parametrize("sign", [
    "class='content-sidebar-wrap'", "class='has-sidebar'", "class='with-menu'", "id='search-page'",
    "class='page search'", "role='search'",
])
@pytest.mark.parametrize("name", ["article", "main", "section"])
def test_wrappers_do_not_empty_a_page(sign, name):
    page = f"<nav>Home</nav><div {sign}><{name}><p>{LONG}</p></{name}></div><footer>c</footer>"
    assert html.main_text(page) == LONG.strip()


@pytest.mark.parametrize(
    "part",
    [
        "<section id='related-work'><p>{}</p></section>", "<h2 id='comments-on-method'>{}</h2>",
        "<h2 id='related'>{}</h2>", "<div class='social-history'><p>{}</p></div>",
    ],
)
def test_names_with_a_hint_in_them_are_content(part):
    page = f"<article><p>{LONG}</p>{part.format('Kept as well.')}<p>{LONG}</p></article>"
    assert html.main_text(page) == f"{LONG.strip()}\nKept as well.\n{LONG.strip()}"


@pytest.mark.parametrize("sign", [
    "class='ad'", "class='comment-list'", "class='site-footer x'", "class='SiteFooter'",
    "id='comments'", "class='related-posts'", "class='a sidebar b'",
])
def test_names_of_other_parts_are_not(sign):
    page = f"<article><p>{LONG}</p><div {sign}><p>{LONG}</p></div></article>"
    assert html.main_text(page) == LONG.strip()
