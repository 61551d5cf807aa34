"""Document quality by a factorisation machine.

Features are hashed words, weighted to unit length, standardised statistics of structure and
size, and metadata: n_chars as the table gives it, whether it does, and how it compares with the
counted length. Besides a weight each, every pair of features interacts through the product of two short
vectors; by the sum-of-squares identity all pairs together cost one pass over the features:
sum over pairs = half of (square of the sum minus sum of the squares). Trained by stochastic
gradient descent on a bounded sample of labelled rows; a part that training does not see turns
the output into a probability.

Defined results
* only labels of rows whose crc32(doc_id) mod 5 is not 0 are learned from; a row's labels that
  contradict each other count as the one that most of them give, ties as 1;
* null text counts as empty; empty text is scored by its statistics alone;
* without any labelled row every score is 0.5;
* rows with a null id count as held out (their remainder is taken as 0); repeated rows each get
  the same result;
* n_chars that is missing, or a column that is none, is a feature of its own;
* an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.textops import (
    IS_SPACE,
    LOWER,
    as_bytes,
    blocks,
    remainder,
    prepare,
    span_hashes,
    tidy,
    word_spans,
)

BUCKETS = 1 << 15
FACTORS = 8
# Labelled rows that training may use, per label. The bound of the sample.
ROWS_PER_LABEL = 2500
# Passes over the sample, and updates at least: a small sample is passed more often.
EPOCHS = 6
UPDATES = 12_000
RATE = 0.05
DECAY = 1e-4
CALIBRATION = 0.25
GOOD_FROM = 0.3

_BYTES = np.arange(256)
# Shares of these byte classes are statistics of a text.
CLASSES = {
    "lower": (_BYTES >= 97) & (_BYTES <= 122),
    "upper": (_BYTES >= 65) & (_BYTES <= 90),
    "digit": (_BYTES >= 48) & (_BYTES <= 57),
    "space": IS_SPACE,
    "line": _BYTES == 10,
    "beyond": _BYTES >= 128,
    "stop": np.isin(_BYTES, list(b".,;:?")),
    "shout": _BYTES == 33,
    "symbol": np.isin(_BYTES, list(b"#*$%&|<>")),
    "bracket": np.isin(_BYTES, list(b"()[]{}")),
    "other": np.isin(_BYTES, list(b"@/\\_=+~^-'\"`")),
}
STATISTICS = len(CLASSES) + 6
# Fields of the metadata: n_chars as it is given, whether it is, and against the counted length.
METADATA = 3
SIZE = BUCKETS + STATISTICS + METADATA


def statistics(text: np.ndarray, lengths: np.ndarray, repeats: np.ndarray) -> np.ndarray:
    """Structure and size of a text: its bytes, word lengths, and how often each word occurs."""
    counts = np.bincount(text, minlength=256)
    size, words = max(len(text), 1), max(len(lengths), 1)
    shares = [counts[mask].sum() / size for mask in CLASSES.values()]
    more = [
        np.log1p(len(text)),
        np.log1p(len(lengths)),
        lengths.mean() if len(lengths) else 0.0,
        lengths.std() if len(lengths) else 0.0,
        len(repeats) / words,
        (repeats.max() if len(repeats) else 0) / words,
    ]
    return np.array([np.sqrt(s) for s in shares] + more, np.float32)


def metadata(text: np.ndarray, n_chars: float) -> np.ndarray:
    """What the table says of a text; n_chars is not a number where it is missing."""
    if np.isnan(n_chars):
        return np.array([0.0, 1.0, 1.0], np.float32)
    counted = int((text & 0xC0 != 0x80).sum())
    given = max(float(n_chars), 0.0)
    return np.array([np.log1p(given), 0.0, min((given + 1) / (counted + 1), 10.0)], np.float32)


def features(
    data: np.ndarray, offsets: np.ndarray, n_chars: np.ndarray
) -> Iterator[tuple[np.ndarray, ...]]:
    """For each text the buckets of its words, their values, and its statistics and metadata."""
    for low, high in blocks(offsets):
        part = data[offsets[low] : offsets[high]]
        places = offsets[low : high + 1] - offsets[low]
        starts, ends, first = word_spans(part, places)
        hashes = span_hashes(LOWER[part], starts, ends)
        numbers = (hashes >> np.uint64(49)).astype(np.int32)
        for i in range(high - low):
            a, b = first[i], first[i + 1]
            buckets, counts = np.unique(numbers[a:b], return_counts=True)
            values = np.sqrt(counts).astype(np.float32)
            values /= max(float(np.sqrt((values**2).sum())), 1e-9)
            lengths = (ends[a:b] - starts[a:b]).astype(np.float32)
            text = part[places[i] : places[i + 1]]
            known = metadata(text, n_chars[low + i])
            yield buckets, values, np.concatenate([statistics(text, lengths, counts), known])


@dataclass
class FactorisationMachine:
    """Weights, factors, the scale of the statistics, and the calibration of the output."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    middle: np.ndarray
    spread: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def inputs(self, buckets: np.ndarray, values: np.ndarray, stats: np.ndarray):
        scaled = np.clip((stats - self.middle) / self.spread, -4, 4) / np.sqrt(STATISTICS + METADATA)
        at = np.concatenate([buckets, np.arange(BUCKETS, SIZE, dtype=np.int32)])
        return at, np.concatenate([values, scaled.astype(np.float32)])

    def raw(self, at: np.ndarray, x: np.ndarray) -> tuple[float, np.ndarray]:
        """The output, and the sums per factor that training needs as well."""
        products = self.factors[at] * x[:, None]
        sums = products.sum(0)
        pairs = 0.5 * float((sums**2).sum() - (products**2).sum())
        return self.bias + float(self.weights[at] @ x) + pairs, sums

    def score(self, buckets: np.ndarray, values: np.ndarray, stats: np.ndarray) -> float:
        output = self.raw(*self.inputs(buckets, values, stats))[0]
        return float(sigmoid(self.slope * output + self.shift))


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


Example = tuple[int, np.ndarray, np.ndarray, np.ndarray]


def train(examples: list[Example], prior: float, seed: int = 11) -> FactorisationMachine | None:
    """A calibrated machine from (label, buckets, values, statistics); None without any.

    prior: share of label 1 among all labelled rows, as the sample takes labels evenly.
    """
    if not examples:
        return None
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(examples))
    split = int(len(order) * CALIBRATION) if len(order) >= 40 else 0
    held, used = order[:split], order[split:]
    stats = np.array([examples[i][3] for i in used])
    machine = FactorisationMachine(
        0.0,
        np.zeros(SIZE, np.float32),
        rng.normal(0, 0.02, (SIZE, FACTORS)).astype(np.float32),
        stats.mean(0),
        stats.std(0) + 1e-3,
    )
    epochs = max(EPOCHS, -(-UPDATES // len(used)))
    steps, done = epochs * len(used), 0
    for _ in range(epochs):
        for i in rng.permutation(used):
            label, *given = examples[i]
            at, x = machine.inputs(*given)
            output, sums = machine.raw(at, x)
            error = float(sigmoid(output)) - label
            rate = RATE * (1 - 0.9 * done / steps)
            factors = machine.factors[at]
            slopes = x[:, None] * (sums - factors * x[:, None])
            machine.bias -= rate * error
            machine.weights[at] -= 10 * rate * (error * x + DECAY * machine.weights[at])
            machine.factors[at] = factors - rate * (error * slopes + DECAY * factors)
            done += 1
    calibrate(machine, [examples[i] for i in (held if split else used)], prior)
    return machine


def calibrate(machine: FactorisationMachine, examples: list[Example], prior: float) -> None:
    """Slope and shift by logistic regression, weighted to the share of label 1 in the table."""
    outputs = np.array([machine.raw(*machine.inputs(*given))[0] for _, *given in examples])
    labels = np.array([label for label, *_ in examples], float)
    ones = min(max(labels.mean(), 1e-3), 1 - 1e-3)
    prior = min(max(prior, 1e-3), 1 - 1e-3)
    weights = np.where(labels == 1, prior / ones, (1 - prior) / (1 - ones))
    # A little smoothing keeps a perfect separation finite.
    targets = labels * 0.998 + 0.001
    point = np.array([1.0, 0.0])
    rows = np.stack([outputs, np.ones_like(outputs)], 1)
    for _ in range(50):
        chance = sigmoid(rows @ point)
        slope = rows.T @ (weights * (chance - targets)) + 1e-3 * point
        curve = (rows * (weights * chance * (1 - chance))[:, None]).T @ rows + 1e-3 * np.eye(2)
        point = point - np.linalg.solve(curve, slope)
    if point[0] > 0:
        machine.slope, machine.shift = float(point[0]), float(point[1])


# --- Spark -----------------------------------------------------------------------------------


def numbers(column: pa.Array) -> np.ndarray:
    """A column of numbers, not a number where they are missing."""
    return column.cast(pa.float64()).to_numpy(zero_copy_only=False)


def _n_chars(documents: DataFrame) -> Column:
    """The column of the metadata; missing where the table has none, or none that is a number."""
    kind = dict(documents.dtypes).get("n_chars", "void")
    given = F.col("n_chars").try_cast("double") if kind != "void" else F.lit(None)
    return given.cast("double").alias("n_chars")


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = list(features(*as_bytes(batch.column(2)), numbers(batch.column(3))))
        parts = zip(*found, strict=True) if found else [()] * 3
        kinds = ("<i4", "<f4", "<f4")
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *(
                pa.array([x.astype(kind).tobytes() for x in part], pa.binary())
                for part, kind in zip(parts, kinds, strict=True)
            )],
            names=["at", "label", "buckets", "values", "stats"],
        )


def fit(documents: DataFrame, labels: DataFrame) -> FactorisationMachine | None:
    """Learn from at most ROWS_PER_LABEL rows per label, the same ones each time."""
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL")
    known = known.where(remainder(F.col("doc_id"), 5) != 0).groupBy("doc_id")
    known = known.agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    counts = {row.label: row.n for row in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    at = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    share = F.lit(0)
    for label, n in counts.items():
        limit = min(1 << 30, int((1 << 30) * ROWS_PER_LABEL / n) + 1)
        share = F.when(F.col("label") == label, limit).otherwise(share)
    # The shares give about the wanted rows; twice as many is a bound that takes from no label.
    bound = 2 * ROWS_PER_LABEL * len(counts)
    picked = known.select("doc_id", "label", at.alias("at"), share.alias("s")).where("at < s")
    picked = picked.orderBy("at", "doc_id").limit(bound)
    texts = documents.select("doc_id", "text", _n_chars(documents)).join(
        F.broadcast(picked.select("doc_id", "label", "at")), "doc_id"
    )
    rows = texts.select("at", "label", "text", "n_chars").mapInArrow(
        tidy(_features), "at long, label int, buckets binary, values binary, stats binary"
    )
    rows = rows.orderBy("at", "buckets").limit(bound).collect()
    of_label = {label: [row for row in rows if row.label == label] for label in counts}
    rows = [row for label in sorted(counts) for row in of_label[label][:ROWS_PER_LABEL]]
    return train(
        [
            (
                row.label,
                np.frombuffer(row.buckets, "<i4"),
                np.frombuffer(row["values"], "<f4"),
                np.frombuffer(row.stats, "<f4"),
            )
            for row in rows
        ],
        counts.get(1, 0) / sum(counts.values()),
    )


def _score(machine: FactorisationMachine | None):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            given = features(*as_bytes(batch.column(2)), numbers(batch.column(3)))
            scores = np.array([machine.score(*x) if machine else 0.5 for x in given], float)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(scores),
                    pa.array((scores >= GOOD_FROM).astype(np.int32)),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return score


def score_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    prepare(documents.sparkSession)
    machine = fit(documents, labels)
    texts = documents.select(
        F.col("doc_id").cast("long"),
        (remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
        "text",
        _n_chars(documents),
    )
    return texts.mapInArrow(
        tidy(_score(machine)), "doc_id long, held_out boolean, score double, predicted int"
    )
