"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text is the mean of the embeddings of its subwords, byte n-grams that do not reach across a
word's end, hashed into buckets. The language scores are linear in that mean. Both layers are
trained by stochastic gradient descent on a bounded sample of labelled rows; a part of it that
training does not see sets the temperature of the softmax and the confidence below which a text
is rejected. As both layers are linear, prediction uses their product, one row of scores per
bucket, which is the same sum in another order.

Defined results
* only text and non-null lang of rows outside the held-out third are learned from;
* text that is null or has no letter: `und`, score 0, rejected; so is all text where nothing
  could be learned (no labelled row). drop_rejected() then keeps all documents, as it has no
  ground to reject one;
* rows with a null id belong to the rows learned from; repeated rows each get the same result;
* an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.textops import (
    IS_SPACE,
    LOWER,
    as_bytes,
    byte_codes,
    mix,
    prepare,
    remainder,
    tidy,
)

UNKNOWN = "und"
BUCKETS = 1 << 15
DIMENSIONS = 16
SIZES = (2, 3, 4)
# Labelled rows that training may use, per language. The bound of the sample.
ROWS_PER_LANGUAGE = 500
# Passes over the sample, and updates at least: a small sample is passed more often.
EPOCHS = 4
UPDATES = 8000
RATE = 0.5
# Share of the sample that only calibrates, and the share of it that may be rejected.
CALIBRATION = 0.25
REJECTED_SHARE = 0.001
# A text whose language is likelier than not is never rejected.
HIGHEST_THRESHOLD = 0.5
# Subwords looked up at once.
AT_ONCE = 1 << 18

FOLDED = LOWER.copy()
FOLDED[IS_SPACE] = 32
FOLDED[48:58] = 48


def subwords(text: np.ndarray) -> np.ndarray:
    """Buckets of the subwords of a text given as bytes, repeats included."""
    padded = np.full(len(text) + 2, 32, np.uint8)
    padded[1:-1] = FOLDED[text]
    codes = byte_codes()[padded]
    inside = padded != 32
    found = []
    total = codes
    for size in range(2, max(SIZES) + 1):
        if len(padded) < size:
            break
        total = total[: len(padded) - size + 1] * np.uint64(0x9E3779B97F4A7C15)
        total = total + codes[size - 1 :]
        if size in SIZES:
            whole = np.ones(len(total), bool)
            for k in range(1, size - 1):
                whole &= inside[k : k + len(total)]
            if size == 2:  # not two spaces
                whole = inside[:-1] | inside[1:]
            found.append((mix(total[whole]) >> np.uint64(49)).astype(np.int32))
    return np.concatenate(found) if found else np.zeros(0, np.int32)


@dataclass
class LanguageModel:
    """Scores per bucket and language, temperature, and the least confidence."""

    languages: list[str]
    table: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def logits(self, text: np.ndarray) -> np.ndarray:
        buckets = subwords(text)
        total = np.zeros(len(self.languages))
        for low in range(0, len(buckets), AT_ONCE):
            total += self.table[buckets[low : low + AT_ONCE]].sum(0, dtype=np.float64)
        return total / max(len(buckets), 1)

    def predict(self, text: np.ndarray) -> tuple[str, float]:
        chances = softmax(self.logits(text) / self.temperature)
        best = int(chances.argmax())
        return self.languages[best], float(chances[best])


def softmax(logits: np.ndarray) -> np.ndarray:
    powers = np.exp(logits - logits.max(-1, keepdims=True))
    return powers / powers.sum(-1, keepdims=True)


def train(
    examples: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 7
) -> LanguageModel | None:
    """A calibrated model from (language, buckets, counts) of texts; None without any."""
    languages = sorted({language for language, _, _ in examples})
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(examples))
    split = int(len(order) * CALIBRATION) if len(order) >= 20 else 0
    held, used = order[:split], order[split:]
    embeddings = rng.normal(0, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    output = np.zeros((DIMENSIONS, len(languages)), np.float32)
    number = {language: i for i, language in enumerate(languages)}
    epochs = max(EPOCHS, -(-UPDATES // len(used)))
    steps, done = epochs * len(used), 0
    for _ in range(epochs):
        for i in rng.permutation(used):
            language, buckets, counts = examples[i]
            weights = (counts / counts.sum()).astype(np.float32)
            mean = weights @ embeddings[buckets]
            error = softmax(mean @ output)
            error[number[language]] -= 1
            rate = RATE * (1 - done / steps)
            back = output @ error
            output -= rate * np.outer(mean, error)
            embeddings[buckets] -= rate * np.outer(np.sqrt(weights), back)
            done += 1
    model = LanguageModel(languages, (embeddings @ output).astype(np.float32))
    if split:
        calibrate(model, [examples[i] for i in held])
    return model


def calibrate(model: LanguageModel, examples: list[tuple[str, np.ndarray, np.ndarray]]) -> None:
    """Temperature by likelihood, then the confidence that few good texts fall below."""
    logits = np.array([(n[:, None] * model.table[b]).sum(0) / n.sum() for _, b, n in examples])
    right = np.array([model.languages.index(language) for language, _, _ in examples])
    rows = np.arange(len(right))

    def loss(temperature: float) -> float:
        return -np.log(np.maximum(softmax(logits / temperature)[rows, right], 1e-12)).mean()

    model.temperature = float(min(np.geomspace(0.02, 10, 60), key=loss))
    sure = softmax(logits / model.temperature).max(1)
    model.threshold = float(min(np.quantile(sure, REJECTED_SHARE), HIGHEST_THRESHOLD))


# --- Spark -----------------------------------------------------------------------------------


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = as_bytes(batch.column(2))
        found = [
            np.unique(subwords(data[a:b]), return_counts=True)
            for a, b in zip(offsets[:-1], offsets[1:], strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array([b.astype("<i4").tobytes() for b, _ in found], pa.binary()),
                pa.array([n.astype("<i4").tobytes() for _, n in found], pa.binary()),
            ],
            names=["at", "lang", "buckets", "counts"],
        )


def fit(documents: DataFrame) -> LanguageModel | None:
    """Learn from at most ROWS_PER_LANGUAGE rows per language, the same ones each time."""
    known = documents.where("lang IS NOT NULL").where(remainder(F.col("doc_id"), 3) != 1)
    counts = {row.lang: row.n for row in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    # A hash of the row picks a share of each language, so no language's rows meet in one task.
    at = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    share = F.lit(0)
    for lang, n in sorted(counts.items()):
        limit = min(1 << 30, int((1 << 30) * ROWS_PER_LANGUAGE / n) + 1)
        share = F.when(F.col("lang") == lang, limit).otherwise(share)
    picked = known.where("text IS NOT NULL").select(at.alias("at"), "lang", "text", share.alias("s"))
    picked = picked.where("at < s").select("at", "lang", "text").mapInArrow(
        tidy(_features), "at long, lang string, buckets binary, counts binary"
    )
    # The shares give about the wanted rows; twice as many is a bound that takes from no language.
    rows = picked.orderBy("at", "lang").limit(2 * ROWS_PER_LANGUAGE * len(counts)).collect()
    examples, taken = [], Counter()
    for row in rows:
        if row.buckets and taken[row.lang] < ROWS_PER_LANGUAGE:
            taken[row.lang] += 1
            examples.append(
                (row.lang, np.frombuffer(row.buckets, "<i4"), np.frombuffer(row.counts, "<i4"))
            )
    return train(examples)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def _predict(model: LanguageModel | None):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            last = batch.column(batch.num_columns - 1)
            whole = pa.types.is_struct(last.type)  # a row with its text, or a text by itself
            texts = pc.struct_field(last, "text") if whole else last
            passed = batch.num_columns if whole else batch.num_columns - 1
            data, offsets = as_bytes(texts)
            names, scores = [], []
            for i, text in enumerate(texts):
                name, score = UNKNOWN, 0.0
                if model and has_letter(text.as_py()):
                    name, score = model.predict(data[offsets[i] : offsets[i + 1]])
                names.append(name)
                scores.append(score)
            threshold = model.threshold if model else 0.0
            rejected = [n == UNKNOWN or s < threshold for n, s in zip(names, scores, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:passed],
                    pa.array(names, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(rejected, pa.bool_()),
                ],
                names=[*batch.schema.names[:passed], "lang_pred", "score", "rejected"],
            )

    return predict


def identify(documents: DataFrame, model: LanguageModel | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected."""
    prepare(documents.sparkSession)
    model = model or fit(documents)
    texts = documents.select(
        F.col("doc_id").cast("long"),
        (remainder(F.col("doc_id"), 3) == 1).alias("held_out"),
        "text",
    )
    return texts.mapInArrow(
        tidy(_predict(model)),
        "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean",
    )


def drop_rejected(documents: DataFrame) -> DataFrame:
    """The documents whose language is told with enough confidence.

    Where no row has a language to learn from nothing can be told, and all documents stay.
    """
    prepare(documents.sparkSession)
    model = fit(documents)
    if model is None:
        return documents
    # Whole rows in one column, so that no name of theirs can clash.
    rows = documents.select(F.struct("*").alias("row"))
    schema = rows.select("row").schema.add("lang_pred", "string").add("score", "double")
    found = rows.mapInArrow(tidy(_predict(model)), schema.add("rejected", "boolean"))
    return found.where(~F.col("rejected")).select("row.*")
