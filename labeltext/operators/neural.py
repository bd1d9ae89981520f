"""A classifier over padded sequences: embedding, mean over the words, one hidden layer.

Weights live on the driver; their size is set by the vocabulary limit and checked. Each
mini-batch is a Spark job: tasks take the gradient of their rows, rows of it are summed
by key, and Adam moves the weights. Epochs go on from one another's weights, and those of
the epoch with the best validation loss are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labeltext.constants import SPLIT_SEED
from labeltext.operators.decompose import _added, _listed
from labeltext.session import materialize

#: Numbers that may be sent to every task, and rows taken through the layers at once.
MOST_WEIGHTS, ROWS = 8 << 20, 512

#: Adam's decay rates and its guard against division by zero.
BETA1, BETA2, TINY = 0.9, 0.999, 1e-8


@dataclass
class Weights:
    """``embedding (words x dim)``, ``hidden (dim x units)``, ``out (units x classes)`` with their biases."""

    embedding: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.embedding, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def copy(self) -> Weights:
        return Weights(*(p.copy() for p in self.parts()))


def fresh(words: int, dim: int, units: int, classes: int, seed: int) -> Weights:
    rng = np.random.default_rng(seed)
    return Weights(
        rng.normal(0, 0.1, (words, dim)), rng.normal(0, np.sqrt(2 / dim), (dim, units)), np.zeros(units),
        rng.normal(0, np.sqrt(1 / units), (units, classes)), np.zeros(classes))


def _blocks(sequences: pa.Array, labels: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    """``(words, row, labels)`` of some rows at a time; 0 is padding and left out."""
    bounds = sequences.offsets.to_numpy()
    flat = sequences.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    for lo in range(0, len(sequences), ROWS):
        hi = min(lo + ROWS, len(sequences))
        words = flat[bounds[lo] - bounds[0] : bounds[hi] - bounds[0]]
        row = np.repeat(np.arange(hi - lo), np.diff(bounds[lo : hi + 1]))
        some = words > 0
        yield words[some], row[some], None if labels is None else labels[lo:hi]


def forward(w: Weights, words: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, ...]:
    """Mean embedding, hidden layer and probabilities of ``n`` rows."""
    size = np.maximum(np.bincount(row, minlength=n), 1)[:, None]
    mean = np.zeros((n, w.embedding.shape[1]))
    if len(row):
        at, first = np.unique(row, return_index=True)
        mean[at] = np.add.reduceat(w.embedding[words], first, axis=0)
    mean /= size
    hidden = np.maximum(mean @ w.hidden + w.hidden_bias, 0)
    z = hidden @ w.out + w.out_bias
    e = np.exp(z - z.max(1, keepdims=True))
    return size, mean, hidden, e / e.sum(1, keepdims=True)


def gradient(w: Weights, words: np.ndarray, row: np.ndarray, labels: np.ndarray, total: Weights) -> tuple[float, int]:
    """Adds the rows' gradient to ``total``; their loss and how many are right."""
    n = len(labels)
    size, mean, hidden, p = forward(w, words, row, n)
    own = np.arange(n)
    loss, right = -np.log(p[own, labels] + 1e-300).sum(), int((p.argmax(1) == labels).sum())
    d = p.copy()
    d[own, labels] -= 1
    total.out += hidden.T @ d
    total.out_bias += d.sum(0)
    d = (d @ w.out.T) * (hidden > 0)
    total.hidden += mean.T @ d
    total.hidden_bias += d.sum(0)
    d = (d @ w.hidden.T) / size
    np.add.at(total.embedding, words, d[row])
    return loss, right


class Adam:
    def __init__(self, weights: Weights, rate: float):
        self.rate, self.step = rate, 0
        self.mean = [np.zeros_like(p) for p in weights.parts()]
        self.square = [np.zeros_like(p) for p in weights.parts()]

    def move(self, weights: Weights, grad: Weights) -> None:
        self.step += 1
        for p, g, m, v in zip(weights.parts(), grad.parts(), self.mean, self.square):
            m *= BETA1
            m += (1 - BETA1) * g
            v *= BETA2
            v += (1 - BETA2) * g * g
            p -= self.rate * (m / (1 - BETA1**self.step)) / (np.sqrt(v / (1 - BETA2**self.step)) + TINY)


def _as_rows(grad: Weights, loss: float, right: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``(key, rows)`` of one width: touched words by their number, the rest in rows after them."""
    words, width = grad.embedding.shape
    touched = np.flatnonzero(grad.embedding.any(1))
    rest = np.concatenate([*(p.ravel() for p in grad.parts()[1:]), [loss, right, n]])
    rest = np.pad(rest, (0, -len(rest) % width)).reshape(-1, width)
    return np.r_[touched, words + np.arange(len(rest))], np.concatenate([grad.embedding[touched], rest])


def _from_rows(keys: np.ndarray, rows: np.ndarray, like: Weights) -> tuple[Weights, float, int, int]:
    words, width = like.embedding.shape
    sizes = [p.size for p in like.parts()[1:]]
    rest = np.zeros((-(-(sum(sizes) + 3) // width), width))
    after = keys >= words
    rest[keys[after] - words] = rows[after]
    flat = np.split(rest.ravel(), np.cumsum([*sizes, 3]))
    out = Weights(np.zeros_like(like.embedding), *(f.reshape(p.shape) for f, p in zip(flat, like.parts()[1:])))
    out.embedding[keys[~after]] = rows[~after]
    loss, right, n = flat[len(sizes)]
    return out, float(loss), int(right), int(n)


@dataclass
class SequenceClassifier:
    """Kept weights; ``history``: ``(epoch, train_loss, train_acc, val_loss, val_acc)`` per epoch."""

    weights: Weights
    history: list[tuple[int, float, float, float, float]]
    best_epoch: int

    def history_table(self, spark: SparkSession) -> DataFrame:
        rows = [(*h, h[0] == self.best_epoch) for h in self.history]
        return spark.createDataFrame(
            rows, "epoch int, train_loss double, train_acc double, val_loss double, val_acc double, kept boolean")

    def predict(self, df: DataFrame, seq: str = "seq") -> DataFrame:
        """``df`` with ``probability``, an array over the classes, and ``prediction``; null or empty sequences too."""
        w = self.weights

        def run(sequences: pa.Array) -> pa.Array:
            found = [forward(w, words, row, min(ROWS, len(sequences) - i * ROWS))[3]
                     for i, (words, row, _) in enumerate(_blocks(sequences.fill_null([]), None))]
            return _listed(np.concatenate(found) if found else np.zeros((0, len(w.out_bias))))

        scored = df.withColumn("probability", F.arrow_udf(run, "array<double>")(F.col(seq)))
        best = F.array_position("probability", F.array_max("probability")) - 1
        return scored.withColumn("prediction", best.cast("double"))


def _batch_gradient(rows: DataFrame, w: Weights, learn: bool) -> tuple[Weights | None, float, int, int]:
    """Summed gradient, loss, right and all of ``rows (seq, label)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = Weights(*(np.zeros_like(p) for p in w.parts()))
        loss, right, n = 0.0, 0, 0
        for batch in batches:
            labels = batch.column(1).to_numpy().astype(np.int64)
            for words, row, own in _blocks(batch.column(0).fill_null([]), labels):
                if learn:
                    more, hits = gradient(w, words, row, own, total)
                else:
                    p = forward(w, words, row, len(own))[3]
                    more = -np.log(p[np.arange(len(own)), own] + 1e-300).sum()
                    hits = int((p.argmax(1) == own).sum())
                loss, right, n = loss + more, right + hits, n + len(own)
        keys, values = _as_rows(total, loss, right, n)
        yield pa.RecordBatch.from_arrays([pa.array(keys), _listed(values)], ["key", "v"])

    partial = rows.select("seq", "label").mapInArrow(run, "key bigint, v array<double>")
    width = w.embedding.shape[1]
    summed = _added(partial, width).toArrow()  # at most the weights
    keys = summed.column("key").to_numpy()
    values = summed.column("v").combine_chunks().flatten().to_numpy().reshape(-1, width)
    return _from_rows(keys, values, w)


def fit_sequences(
    rows: DataFrame, n_classes: int, num_words: int, id_col: str = "doc_id", seq: str = "seq", label: str = "label",
    is_val: str = "is_val", dim: int = 32, units: int = 32, epochs: int = 15, batches: int = 8, rate: float = 0.01,
    seed: int = SPLIT_SEED,
) -> SequenceClassifier:
    """Train on ``rows (id, seq, label, is_val)``; word numbers run from 1 to ``num_words``, 0 pads.

    Each epoch deals the training rows anew over ``batches`` mini-batches by a hash of id and
    epoch, so runs repeat whatever the partitioning. Losses are means; without validation
    rows the training loss picks the epoch. Rows with a null label are left out; an
    empty training table leaves the first weights and no history.
    """
    w = fresh(num_words + 1, dim, units, n_classes, seed)
    if sum(p.size for p in w.parts()) > MOST_WEIGHTS:
        raise ValueError(f"more than {MOST_WEIGHTS} weights; lower num_words, dim or units")
    kept = rows.where(F.col(label).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(seq).alias("seq"), F.col(label).cast("int").alias("label"), F.col(is_val).alias("is_val"))
    kept = materialize(kept, "sequences")
    train, validation = kept.where("not is_val"), kept.where("is_val")
    adam, best, history = Adam(w, rate), (np.inf, 0, w.copy()), []
    for epoch in range(1, epochs + 1):
        loss, right, n = 0.0, 0, 0
        for b in range(batches):
            mine = train.where(F.pmod(F.xxhash64("id", F.lit(epoch), F.lit(seed)), F.lit(batches)) == b)
            grad, more, hits, size = _batch_gradient(mine, w, True)
            if size:
                for p in grad.parts():
                    p /= size
                adam.move(w, grad)
            loss, right, n = loss + more, right + hits, n + size
        if not n:
            break
        _, val_loss, val_right, val_n = _batch_gradient(validation, w, False)
        val = val_loss / val_n if val_n else loss / n
        history.append((epoch, loss / n, right / n, val, val_right / val_n if val_n else right / n))
        if val < best[0]:
            best = val, epoch, w.copy()
    return SequenceClassifier(best[2], history, best[1])
