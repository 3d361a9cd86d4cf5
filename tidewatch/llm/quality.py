"""Quality classifier: n-gram indicators scaled by naive Bayes log-count ratios, then a linear hinge-loss model.

Features of a text: which hashed byte n-grams (one to three bytes) occur in it, and which runs of repetition among its words:
n-grams of the sequence that says of each word whether it equals the one, two or three places back. Each indicator is multiplied by
the log ratio of its smoothed counts in the two classes, the vector is scaled by its length (a short text's less than to unit
length: it says little), and a support vector machine is fitted by dual coordinate descent. A logistic curve through the
margins turns them into scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import texts

BITS = 16
#: A model is fitted on this many labelled rows at most (about; chosen by a hash of the id, all if there are fewer).
SAMPLE_ROWS = 4000
_CHUNK = 1 << 20
#: Lengths of the runs of repeated words that are told apart, for each distance.
_RUNS, _BACK = (1, 2, 3, 4, 6, 8, 12, 16), (1, 2, 3)
SIZE = (1 << BITS) + len(_RUNS) * len(_BACK)


def _repeats(text: bytes) -> list[int]:
    """Numbers of the runs of words equal to the word some places back that occur in the text."""
    words, found = text.split(), []
    for k, back in enumerate(_BACK):
        same = np.fromiter(map(eq, words[back:], words), np.int8, max(0, len(words) - back))
        edges = np.flatnonzero(np.diff(same, prepend=0, append=0))
        longest = int((edges[1::2] - edges[::2]).max()) if len(edges) else 0
        found += [(1 << BITS) + k * len(_RUNS) + j for j, n in enumerate(_RUNS) if longest >= n]
    return found


def features(text: bytes) -> np.ndarray:
    """Sorted numbers of the n-grams that occur anywhere in the text."""
    seen = np.zeros(SIZE, bool)
    seen[_repeats(text)] = True
    for at in range(0, len(text), _CHUNK):
        b = np.frombuffer(text[max(0, at - 2) : at + _CHUNK], np.uint8).astype(np.uint32)
        h = b + np.uint32(1)
        for n in range(3):
            if n:
                h = h[:-1] * np.uint32(263) + b[n:] + np.uint32(1)
            seen[((h + np.uint32(n << 24)) * np.uint32(2654435761)) >> np.uint32(32 - BITS)] = True
    return np.flatnonzero(seen).astype(np.uint32)


@dataclass
class Model:
    """ratio: naive Bayes log-count ratios; length: what a vector's own length is padded with; slope and shift give the score."""

    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    length: float = 1.0
    slope: float = 1.0
    shift: float = 0.0

    def values(self, x: np.ndarray) -> np.ndarray:
        r = self.ratio[x]
        return r / np.sqrt(r @ r + self.length**2)

    def margin(self, x: np.ndarray) -> float:
        return float(self.weight[x] @ self.values(x)) + self.bias

    def score(self, text: bytes) -> float:
        return 1.0 / (1.0 + float(np.exp(-np.clip(self.slope * self.margin(features(text)) + self.shift, -500, 500))))


def fit(rows: list[np.ndarray], labels: np.ndarray, cost: float = 1.0, epochs: int = 15, seed: int = 7) -> Model:
    """Fit on indicator rows and labels 0 or 1. With one class or no rows the score is the share of label 1 (0.5 without rows)."""
    size, n = SIZE, len(rows)
    positive = int((labels == 1).sum())
    if not n or positive in (0, n):
        share = (positive + 0.5) / (n + 1)
        return Model(np.zeros(size), np.zeros(size), 0.0, shift=float(np.log(share / (1 - share))))
    counts = [np.ones(size), np.ones(size)]
    for x, y in zip(rows, labels, strict=True):
        counts[int(y)][x] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    model = Model(ratio, np.zeros(size), 0.0, float(np.median([np.sqrt(ratio[x] @ ratio[x]) for x in rows])) or 1.0)
    values = [model.values(x) for x in rows]
    sign = np.where(labels == 1, 1.0, -1.0)
    upper = cost * np.where(labels == 1, n / (2 * positive), n / (2 * (n - positive)))
    norm = np.array([v @ v + 1.0 for v in values])
    w, bias, alpha = np.zeros(size), 0.0, np.zeros(n)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        most = 0.0
        for i in rng.permutation(n):
            x, v = rows[i], values[i]
            gradient = sign[i] * (w[x] @ v + bias) - 1.0
            new = min(max(alpha[i] - gradient / norm[i], 0.0), upper[i])
            if step := (new - alpha[i]) * sign[i]:
                w[x] += step * v
                bias += step
                alpha[i] = new
                most = max(most, abs(step))
        if most < 1e-3:
            break
    margins = np.array([w[x] @ v + bias for x, v in zip(rows, values, strict=True)])
    # a logistic curve with smoothed targets, by Newton steps on the two parameters
    target = np.where(labels == 1, (positive + 1) / (positive + 2), 1 / (n - positive + 2))
    weight = np.where(labels == 1, n / (2 * positive), n / (2 * (n - positive)))
    ab = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(ab[0] * margins + ab[1], -30, 30)))
        g = weight * (p - target)
        c = weight * p * (1 - p)
        hess = np.array([[(c * margins * margins).sum() + 1e-6, (c * margins).sum()], [(c * margins).sum(), c.sum() + 1e-6]])
        move = np.linalg.solve(hess, np.array([(g * margins).sum(), g.sum()]))
        ab -= np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-6:
            break
    return Model(ratio, w, bias, model.length, float(max(ab[0], 1e-3)), float(ab[1]))


def held_out(doc_id: Column) -> Column:
    """Whether a document is never learned from: crc32 of its id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on a bounded sample of the labelled rows that are not held out; only their feature numbers reach the driver.

    Null ids or labels and labels other than 0 and 1 are ignored; of several labels of one id the largest counts.
    """
    own = labels.where("quality in (0, 1) and doc_id is not null").select(F.col("doc_id").cast("long").alias("id"), "quality")
    own = own.where(~held_out(F.col("id"))).groupBy("id").agg(F.max("quality").alias("y"))
    n = own.count()
    spread = 1 << 30
    if n > sample_rows:
        own = own.where(F.pmod(F.xxhash64("id"), F.lit(spread)) < int(spread * sample_rows / n))
    text = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("binary").alias("text"))
    chosen = text.join(F.broadcast(own), "id").select("y", "text")  # the sample is bounded by sample_rows

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t).tobytes() for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()), pa.array(found, pa.binary())], ["y", "x"])

    rows = chosen.mapInArrow(extract, "y int, x binary").collect()
    rows.sort(key=lambda r: (r["y"], bytes(r["x"])))  # the order in which tasks end must not matter
    return fit([np.frombuffer(bytes(r["x"]), np.uint32) for r in rows], np.array([r["y"] for r in rows], int))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and predicted of every row: null text counts as empty, and the whole text counts however long it is.

    A score of just 0.5 predicts 1; rows that repeat an id, or have none, are scored each for itself; an empty table gives an empty one.
    """

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = np.array([model.score(t) for t in texts(batch)], float)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"]
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(scored, "doc_id bigint, score double, predicted int")


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows that score at least the threshold, with the columns they came with.

    Null texts are scored as empty ones; a score of just the threshold stays; rows that repeat an id, or have none, are judged each for itself; an
    empty table gives an empty one.
    """
    names = docs.columns

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                text = batch.column(names.index("text")).cast(pa.large_binary() if pa.types.is_large_string(batch.column(names.index("text")).type) else pa.binary())
                yield batch.filter(pa.array([model.score(t or b"") >= threshold for t in text.to_pylist()]))

    return docs.mapInArrow(kept, docs.schema)
