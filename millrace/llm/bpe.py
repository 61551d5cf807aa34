"""Byte-pair encoding and decoding with a segment tree over adjacent pair ranks.

The leaves of a word's tree hold the rank of each adjacent pair of symbols, with its position as
the tie-break, and every node the smaller of its children: the root is the leftmost pair of
lowest rank. A merge changes three leaves and their ancestors, a logarithmic update, until the
root says that no pair can be merged. Short words are encoded many at a time, one tree per row of
a matrix; long ones each with a tree of its own.

Words repeat, so each worker remembers words it has encoded, up to a number that bounds memory;
this changes only the time taken.

Defined results
* null counts as the empty text: no ids, empty decoded text;
* strings of special tokens inside a text become their ids, as the vocabulary file says;
* one row per input row, whatever repeats; other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.textops import prepare, tidy

# Words that a worker remembers; with their ids and tokens about 100 MB.
REMEMBERED = 250_000
# Longer words (bytes) get a tree of their own.
SHORT = 64
# Words encoded together.
TOGETHER = 4096

NO_PAIR = np.iinfo(np.int64).max


def byte_alphabet() -> list[str]:
    """The printable stand-in of each byte, by the rule that defines byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Vocabulary:
    """The parts of a tokenizer file that the encoder needs."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.special = {token["content"]: token["id"] for token in content["added_tokens"]}
        self.tokens = {number: token for token, number in self.ids.items()}
        self.tokens |= {number: token for token, number in self.special.items()}
        # A pair of ids as one number, sorted, with the rank and the id that it becomes.
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        pairs = np.array([self.pair(self.ids[a], self.ids[b]) for a, b in merges], np.int64)
        result = np.array([self.ids[a + b] for a, b in merges], np.int64)
        order = np.argsort(pairs, kind="stable")
        self.pairs, self.ranks, self.merged = pairs[order], order.astype(np.int64), result
        self.rank_of = dict(zip(pairs.tolist(), range(len(merges)), strict=True))
        alphabet = byte_alphabet()
        self.inner = np.array([self.ids[c] for c in alphabet], np.int64)
        self.final = np.array([self.ids[c + self.suffix] for c in alphabet], np.int64)
        library = Tokenizer.from_file(path)
        self.normalize = library.normalizer.normalize_str
        self.split = library.pre_tokenizer.pre_tokenize_str
        self.byte_of = {c: b for b, c in enumerate(alphabet)}

    @staticmethod
    def pair(left: int, right: int) -> int:
        return left << 32 | right

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids; NO_PAIR where the two cannot be merged."""
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where(self.pairs[at] == wanted, self.ranks[at], NO_PAIR)


def encode_long(word: bytes, vocabulary: Vocabulary) -> list[int]:
    """One word, one tree: an array of nodes, the children of node i at 2i and 2i + 1."""
    symbols = vocabulary.inner[np.frombuffer(word, np.uint8)].tolist()
    symbols[-1] = int(vocabulary.final[word[-1]])
    count = len(symbols)
    leaves = 1 << max(1, (count - 1).bit_length())
    none = (NO_PAIR, count)
    rank_of, merged, pair = vocabulary.rank_of, vocabulary.merged, vocabulary.pair
    after, before = list(range(1, count + 1)), list(range(-1, count - 1))

    def leaf(i: int) -> tuple[int, int]:
        j = after[i]
        rank = rank_of.get(pair(symbols[i], symbols[j])) if j < count else None
        return none if rank is None else (rank, i)

    tree = [none] * (2 * leaves)
    for i in range(count):
        tree[leaves + i] = leaf(i)
    for node in range(leaves - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])

    def put(i: int, value: tuple[int, int]) -> None:
        node = leaves + i
        tree[node] = value
        while node > 1:
            node >>= 1
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

    while tree[1] is not none and tree[1][0] != NO_PAIR:
        rank, i = tree[1]
        j = after[i]
        symbols[i] = int(merged[rank])
        after[i] = after[j]
        if after[j] < count:
            before[after[j]] = i
        put(j, none)
        put(i, leaf(i))
        if before[i] >= 0:
            put(before[i], leaf(before[i]))
    out, i = [], 0
    while i < count:
        out.append(symbols[i])
        i = after[i]
    return out


def encode_short(words: list[bytes], vocabulary: Vocabulary) -> list[list[int]]:
    """Words of up to SHORT bytes, a tree per row; all rows take their next merge together."""
    lengths = np.array([len(w) for w in words], np.int64)
    width = 1 << max(1, int(lengths.max() - 1).bit_length())
    rows = np.arange(len(words))
    raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8)
    symbols = np.zeros((len(words), width + 1), np.int64)
    symbols[:, :width] = vocabulary.inner[raw.reshape(len(words), width)]
    symbols[rows, lengths - 1] = vocabulary.final[raw.reshape(len(words), width)[rows, lengths - 1]]
    place = np.arange(width)
    after = np.tile(np.arange(1, width + 2), (len(words), 1))
    before = np.tile(np.arange(-1, width), (len(words), 1))
    alive = place < lengths[:, None]

    tree = np.full((len(words), 2 * width), NO_PAIR, np.int64)
    ranks = vocabulary.lookup(symbols[:, : width - 1], symbols[:, 1:width])
    paired = (place[1:] < lengths[:, None]) & (ranks != NO_PAIR)
    tree[:, width : 2 * width - 1] = np.where(paired, ranks * width + place[:-1], NO_PAIR)
    level = width >> 1
    while level:
        tree[:, level : 2 * level] = np.minimum(
            tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2]
        )
        level >>= 1

    def put(row: np.ndarray, at: np.ndarray, value: np.ndarray) -> None:
        node = at + width
        tree[row, node] = value
        while node[0] > 1:
            node = node >> 1
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])

    def pair_key(row: np.ndarray, at: np.ndarray) -> np.ndarray:
        to = after[row, at]
        has = to < lengths[row]
        to = np.where(has, to, 0)
        rank = vocabulary.lookup(symbols[row, at], symbols[row, to])
        return np.where(has & (rank != NO_PAIR), rank * width + at, NO_PAIR)

    row = rows[tree[:, 1] != NO_PAIR]
    while len(row):
        root = tree[row, 1]
        at, rank = root % width, root // width
        gone = after[row, at]
        symbols[row, at] = vocabulary.merged[rank]
        onward = after[row, gone]
        after[row, at] = onward
        before[row, np.minimum(onward, width)] = at
        alive[row, gone] = False
        put(row, gone, np.full(len(row), NO_PAIR))
        put(row, at, pair_key(row, at))
        back = before[row, at]
        some = back >= 0
        if some.any():
            put(row[some], back[some], pair_key(row[some], back[some]))
        row = row[tree[row, 1] != NO_PAIR]
    sizes = np.cumsum(alive.sum(1))[:-1]
    return [part.tolist() for part in np.split(symbols[:, :width][alive], sizes)]


class Encoder:
    """Encodes and decodes whole texts, remembering words."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.vocabulary = vocabulary = Vocabulary(path)
        self.remembered = remembered
        # word to (ids as bytes, tokens joined by spaces)
        self.ids: dict[str, bytes] = {}
        self.tokens: dict[str, str] = {}
        special = "|".join(re.escape(token) for token in sorted(vocabulary.special, reverse=True))
        self.special = re.compile(f"({special})") if special else None
        # Latin letters in the order of their code points; here Python's rules and those of the
        # library agree. Other texts are normalised and split by the library.
        letters = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
        digits = "0-9\xb2\xb3\xb9\xbc-\xbe"
        self.usual = re.compile("[\t-\r -~\xa0-įı-ɏ]*")
        self.words = re.compile(
            f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{digits}]|[^\\s{letters}{digits}]+"
        )

    def pieces(self, text: str) -> list[str]:
        """The words of a text without special tokens, as the file's rules split them."""
        if self.usual.fullmatch(text):
            return self.words.findall(text.lower())
        split = self.vocabulary.split(self.vocabulary.normalize(text))
        byte_of = self.vocabulary.byte_of
        # Surrogates stand for bytes that are no whole characters; words are only keys here.
        return [
            bytes(byte_of[c] for c in word).decode("utf-8", "surrogateescape") for word, _ in split
        ]

    def learn(self, words: set[str]) -> None:
        """Encode words that are not remembered yet."""
        missing = [w for w in words if w not in self.ids]
        if len(self.ids) + len(missing) > self.remembered:
            self.ids.clear()
            self.tokens.clear()
            missing = list(words)
        raw = [w.encode("utf-8", "surrogateescape") for w in missing]
        order = sorted(range(len(raw)), key=lambda i: len(raw[i]))
        done = 0
        while done < len(order) and len(raw[order[done]]) <= SHORT:
            size = 1 << (len(raw[order[done]]) - 1).bit_length()
            end = done
            while end < min(len(order), done + TOGETHER) and len(raw[order[end]]) <= size:
                end += 1
            part = order[done:end]
            found = encode_short([raw[i] for i in part], self.vocabulary)
            for i, ids in zip(part, found, strict=True):
                self.remember(missing[i], ids)
            done = end
        for i in order[done:]:
            self.remember(missing[i], encode_long(raw[i], self.vocabulary))

    def remember(self, word: str, ids: list[int]) -> None:
        self.ids[word] = np.array(ids, "<u4").tobytes()
        self.tokens[word] = " ".join(map(self.vocabulary.tokens.__getitem__, ids))

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """For each text its ids as little-endian 32-bit numbers, and the text they decode to."""
        special = self.vocabulary.special
        parted = []
        for text in texts:
            parts = self.special.split(text) if self.special else [text]
            parted.append([[p] if p in special else self.pieces(p) for p in parts if p])
        plain = {w for parts in parted for words in parts for w in words} - special.keys()
        self.learn(plain)
        ids, tokens = self.ids, self.tokens
        named = {w: np.array([n], "<u4").tobytes() for w, n in special.items()}
        for parts in parted:
            words = [w for part in parts for w in part]
            if len(parts) > 1:
                coded = [named.get(w) or ids[w] for w in words]
                decoded = [w if w in special else tokens[w] for w in words]
            else:
                coded, decoded = map(ids.__getitem__, words), map(tokens.__getitem__, words)
                if words and words[0] in special:
                    coded, decoded = [named[words[0]]], words
            yield b"".join(coded), " ".join(decoded)


@functools.lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    return Encoder(path)


# Characters that are encoded together.
ROUND_CHARS = 500_000


def _encode(tokenizer_path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(tokenizer_path)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            sizes, of_ids, of_text, low = [], [], [], 0
            while low < len(texts):
                high, chars = low, 0
                while high < len(texts) and (high == low or chars < ROUND_CHARS):
                    chars += len(texts[high])
                    high += 1
                for ids, decoded in tool.encode(texts[low:high]):
                    sizes.append(len(ids) // 4)
                    of_ids.append(hashlib.sha256(ids).hexdigest())
                    of_text.append(hashlib.sha256(decoded.encode()).hexdigest())
                low = high
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), *map(
                    lambda c: pa.array(c, pa.string()), (of_ids, of_text)
                )],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return encode


def encode_documents(documents: DataFrame, tokenizer_path: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    prepare(documents.sparkSession)
    texts = documents.select(F.col("doc_id").cast("long"), "text")
    return texts.mapInArrow(
        tidy(_encode(tokenizer_path)),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
