"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j), where the pairs are summed in time linear in
the features: for each factor f, half of (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2.

The machine is fitted on a bounded, fixed sample of labelled rows; scoring runs over all documents.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that the machine is fitted on at most.
SAMPLE_ROWS = 6000
#: Buckets that words are hashed to.
HASHED = 1 << 14
FACTORS = 8
_SYMBOLS = re.compile(r"[^\w\s.,;:!?'\"()\-]")
_UPPER = re.compile(r"\b[^\W\d_a-z]{2,}\b")
STATS = 18


def statistics(text: str, words: list[str]) -> list[float]:
    """Structure of the text and its length; all 0 for an empty text."""
    n, m = len(text), len(words)
    if not m:
        return [0.0] * STATS
    distinct = len(set(words))
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    lines = text.split("\n")
    return [
        np.log1p(n) / 10,
        np.log1p(m) / 10,
        min(n / m, 40) / 10,
        distinct / m,
        again / m,
        np.log1p(distinct) / 10,
        len(_SYMBOLS.findall(text)) / m,
        sum(map(str.isupper, words)) / m,
        text.count("!") / m,
        text.count("|") / m,
        (text.count(".") + text.count(",")) / m,
        sum(map(str.isdigit, text)) / n,
        sum(map(str.istitle, words)) / m,
        len(lines) / m,
        1 - len(set(lines)) / len(lines),
        sum(w[-1].isalnum() for w in words) / m,
        text.count("%") / m,
        text.count("@") / m,
    ]


def features(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word buckets, their values, statistics).  Values are root counts over the root of the words."""
    words = text.split()
    low = [crc32(w.encode()) & (HASHED - 1) for w in text.lower().split()]
    index, count = np.unique(np.array(low, np.int64), return_counts=True)
    value = np.sqrt(count / max(1, len(low)))
    return index, value / max(1e-9, float(np.sqrt((value**2).sum()))) if len(value) else value, np.array(statistics(text, words))


@dataclass
class Machine:
    bias: float
    weights: np.ndarray  # HASHED + STATS
    factors: np.ndarray  # (HASHED + STATS, FACTORS)
    mean: np.ndarray
    scale: np.ndarray

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        return self.joined(*features(text))

    def joined(self, index: np.ndarray, value: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (
            np.r_[index, np.arange(HASHED, HASHED + STATS)],
            np.r_[value, np.clip((stats - self.mean) / self.scale, -4, 4) / np.sqrt(STATS)],
        )

    def raw(self, index: np.ndarray, value: np.ndarray) -> float:
        v = self.factors[index] * value[:, None]
        total = v.sum(axis=0)
        return float(self.bias + self.weights[index] @ value + 0.5 * (total @ total - (v * v).sum()))

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.raw(*self.vector(text)), -40, 40))))


def fit(
    known: list[tuple[np.ndarray, np.ndarray, np.ndarray]],
    labels: list[int],
    epochs: int = 12,
    rate: float = 0.05,
    decay: float = 1e-4,
    seed: int = 7,
) -> Machine:
    """AdaGrad over the ``features`` of a sample, in a fixed shuffled order.  With one class or none the score is its share."""
    rng = np.random.default_rng(seed)
    stats = np.array([x[2] for x in known]) if known else np.zeros((1, STATS))
    share = (sum(labels) + 0.5) / (len(labels) + 1)
    machine = Machine(
        float(np.log(share / (1 - share))),
        np.zeros(HASHED + STATS),
        rng.normal(0, 0.05, (HASHED + STATS, FACTORS)),
        stats.mean(axis=0),
        np.maximum(stats.std(axis=0), 1e-3),
    )
    if len(set(labels)) < 2:
        machine.factors[:] = 0
        return machine
    rows = [machine.joined(*x) for x in known]
    g_w, g_v, g_b = np.full(HASHED + STATS, 1e-2), np.full((HASHED + STATS, FACTORS), 1e-2), 1e-2
    for _ in range(epochs):
        for r in rng.permutation(len(rows)):
            index, x = rows[r]
            v = machine.factors[index]
            total = (v * x[:, None]).sum(axis=0)
            raw = machine.bias + machine.weights[index] @ x + 0.5 * (total @ total - ((v * x[:, None]) ** 2).sum())
            error = 1 / (1 + np.exp(-np.clip(raw, -40, 40))) - labels[r]
            d_w = error * x + decay * machine.weights[index]
            d_v = error * x[:, None] * (total[None, :] - v * x[:, None]) + decay * v
            g_b += error * error
            g_w[index] += d_w * d_w
            g_v[index] += d_v * d_v
            machine.bias -= rate * error / np.sqrt(g_b)
            machine.weights[index] -= rate * d_w / np.sqrt(g_w[index])
            machine.factors[index] -= rate * d_v / np.sqrt(g_v[index])
    return machine


def learn(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> Machine:
    """Fits on at most ``sample_rows`` labelled rows for which ``usable`` (of the id) holds.

    The sample is the rows of ``labels`` whose md5 of the id comes first; it is bounded before it meets the
    documents, so the join broadcasts at most ``sample_rows`` ids.  Null labels and null texts are not
    learned from; several labels of one document are all learned from.  The driver gets features, not texts: at
    most ``HASHED`` x 6 bytes of a row, however long its text.
    """
    first = F.md5(F.col(id_col).cast("string").cast("binary"))
    known = labels.where(usable & F.col(label_col).isNotNull())
    # Only hashes that can be among the first are sorted: about four times the sample, however many rows there are.
    place = F.conv(F.substring("h", 1, 8), 16, 10).cast("double") / 2.0**32
    sample = (
        known.select(F.col(id_col).cast("long").alias("k"), F.col(label_col).cast("int").alias("y"), first.alias("h"))
        .where(place * known.count() <= 4.0 * sample_rows)
        .orderBy("h", "k", "y")
        .limit(sample_rows)
    )
    rows = docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).cast("string").alias("t")).where("t is not null")

    def packed(batches):
        for batch in batches:
            found = [features(t.as_py()) for t in batch.column(3)]
            sparse = [x[0].astype("<u2").tobytes() + x[1].astype("<f4").tobytes() for x in found]
            columns = [*batch.columns[:3], pa.array(sparse, pa.binary()), pa.array([x[2].tolist() for x in found], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["h", "k", "y", "words", "stats"])

    joined = rows.join(F.broadcast(sample), "k").select("h", "k", "y", "t")
    chosen = joined.mapInArrow(packed, "h string, k long, y int, words binary, stats array<double>")
    chosen = chosen.orderBy("h", "k", "y", "words", "stats").limit(sample_rows).collect()

    def unpacked(r):
        n = len(r["words"]) // 6
        index = np.frombuffer(r["words"], "<u2", n).astype(np.int64)
        return index, np.frombuffer(r["words"], "<f4", n, 2 * n).astype(float), np.array(r["stats"])

    return fit([unpacked(r) for r in chosen], [1 if r["y"] > 0 else 0 for r in chosen])


def score(docs: DataFrame, machine: Machine, text_col: str = "text", output: str = "score") -> DataFrame:
    """All columns of ``docs`` and ``output``, the probability of label 1, from the whole text alone.

    An input column named ``output`` is replaced.  Null counts as an empty text.  Equal texts score equally; repeated rows each return a row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # fixed size: HASHED x FACTORS numbers

    @F.pandas_udf("double")
    def scored(texts):
        return texts.map(lambda t: shared.value.score(t if isinstance(t, str) else ""))

    return docs.withColumn(output, scored(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))
