"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; all other texts are unlabelled, whatever
their label says. A linear model over words and beginnings of words minimises

    prior * R(positive as 1) + max(0, R(unlabelled as 0) - prior * R(positive as 0)),

R being the mean logistic loss. Which features the model may use is decided by
counts over all texts; its weights are fitted with numpy on bounded samples.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labeltext.llm.names import quoted
from labeltext.llm.textvec import FEW_BYTES, words

#: Bytes of a word's beginning that are features besides the whole word.
PREFIXES = (3, 4, 5, 6)

#: Bounds of the fit: confirmed positives and unlabelled texts whose features train
#: the weights, candidate features that are counted over all texts, features kept.
MOST_POSITIVES = 20_000
MOST_UNLABELLED = 40_000
MOST_CANDIDATES = 65_536
MOST_FEATURES = 2_048

#: A feature has to be in so many positives, in such a share of them, and so many
#: times more common there than among all texts (two thirds of that at two standard
#: errors less, so that a handful of texts proves nothing).
LEAST_TEXTS, LEAST_SHARE, LEAST_LIFT = 3, 0.01, 3.0

#: A feature's value: its share among the words, in percent, no more than so much;
#: shorter texts count as having so many words.
MOST_PERCENT, FEW_WORDS = 3.0, 20

THRESHOLD, MOST_PRIOR = 0.7, 0.5


@dataclass
class Model:
    features: np.ndarray  # sorted 64-bit hashes
    weights: np.ndarray
    bias: float


def _looked_up(texts: pa.Array, features: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, place in features, value)`` of every feature a text has.

    The value is the feature's share among the text's words, in percent up to
    MOST_PERCENT, as if the text had FEW_WORDS words at least.
    """
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    if not len(features):
        return out[0]
    # a small table by the low bits keeps most look-ups from a search
    maybe = np.zeros(1 << 20, bool)
    maybe[(features & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
    for part in words(texts, lower=True, pieces=True, chunk_bytes=FEW_BYTES):
        row, size = part.row, np.maximum(np.diff(part.bounds), FEW_WORDS)
        found = [(np.arange(len(row)), part.hashes()), *(part.prefixes(n) for n in PREFIXES)]
        for kind, (which, h) in enumerate(found):
            h = h + np.uint64(kind)
            hit = np.flatnonzero(maybe[(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
            at = np.minimum(np.searchsorted(features, h[hit]), len(features) - 1)
            same = features[at] == h[hit]
            pair, n = np.unique(row[which[hit[same]]] * len(features) + at[same], return_counts=True)
            own = pair // len(features)
            out.append((own + part.first, pair % len(features), np.minimum(100 * n / size[own], MOST_PERCENT)))
    return tuple(np.concatenate(x) for x in zip(*out))


def _all_features(texts: pa.Array) -> Iterator[np.ndarray]:
    """Hashes of all distinct features of each text, one after another, some texts at a time."""
    for part in words(texts, lower=True, pieces=True, chunk_bytes=FEW_BYTES):
        row = part.row
        found = [(np.arange(len(row)), part.hashes()), *(part.prefixes(n) for n in PREFIXES)]
        r = np.concatenate([row[w] for w, _ in found])
        h = np.concatenate([h + np.uint64(k) for k, (_, h) in enumerate(found)])
        order = np.lexsort((h, r))
        r, h = r[order], h[order]
        yield h[np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (h[1:] != h[:-1])])] if len(h) else h


def _tally(docs: DataFrame, text_col: str, features: np.ndarray | None) -> DataFrame:
    """``(feature, n)``: texts of ``docs`` that have each feature, of ``features`` if given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = None if features is None else np.zeros(len(features), np.int64)
        for batch in batches:
            if features is None:
                for found in _all_features(batch.column(0)):
                    h, n = np.unique(found, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["feature", "n"])
            else:
                _, places, _ = _looked_up(batch.column(0), features)
                counts += np.bincount(places, minlength=len(features))
        if features is not None:
            seen = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(features[seen].view(np.int64)), pa.array(counts[seen])], ["feature", "n"])

    rows = docs.select(text_col).mapInArrow(run, "feature bigint, n bigint")
    return rows.groupBy("feature").agg(F.sum("n").alias("n"))


def _array(df: DataFrame, *columns: str) -> list[np.ndarray]:
    table = df.select(*columns).toArrow()
    return [table.column(c).to_numpy() for c in columns]


def fit(row: np.ndarray, place: np.ndarray, value: np.ndarray, toxic: np.ndarray, width: int, prior: float,
        steps: int = 500, rate: float = 0.05, decay: float = 1e-5) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on the non-negative risk.

    ``row, place, value``: the features a text has; ``toxic``: which texts are confirmed.
    Where the second part of the risk falls below zero, its gradient is turned
    round, so that the model gives up what it has fitted too far.
    """
    w, b = np.zeros(width), np.log(prior / (1 - prior))
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    n_p, n_u = max(1, toxic.sum()), max(1, (~toxic).sum())
    for t in range(1, steps + 1):
        z = np.bincount(row, w[place] * value, len(toxic)) + b
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        as_zero = np.logaddexp(0, z)  # the loss of calling a text 0
        second = as_zero[~toxic].sum() / n_u - prior * as_zero[toxic].sum() / n_p
        grad = np.where(toxic, -prior * p / n_p, p / n_u)
        if second < 0:
            grad = -grad
        grad = grad + np.where(toxic, prior * (p - 1) / n_p, 0)
        g = np.append(np.bincount(place, grad[row] * value, width) + decay * w, grad.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, float(b)


def train(docs: DataFrame, confirmed: DataFrame, prior: float, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model from the ids in ``confirmed`` (toxic texts of ``docs``) and all of ``docs``, unlabelled.

    ``prior``: share of toxic texts. Samples take the smallest digests of the id,
    so they don't depend on the order of rows, nor on ties or repeated rows (an id counts
    once). Null ids and null texts are fine. Without positives, or where nothing tells them
    apart, the model has no features and its score is the prior. Labelled rows are picked,
    so their share of toxic ones may be far above that of all texts; a prior counts as
    MOST_PRIOR at most, which keeps a model that knows nothing below THRESHOLD.
    """
    prior = min(max(prior, 1e-4), MOST_PRIOR)
    base = Model(np.zeros(0, np.uint64), np.zeros(0), float(np.log(prior / (1 - prior))))
    key = F.xxhash64(F.col(id_col))
    positives = confirmed.select(id_col).where(F.col(id_col).isNotNull()).distinct().orderBy(key).limit(MOST_POSITIVES)
    pos_docs = docs.join(F.broadcast(positives), id_col, "left_semi")  # MOST_POSITIVES ids at most
    tally = _tally(pos_docs, text_col, None)
    p_size = float(pos_docs.select(id_col).count())
    top = tally.where(F.col("n") >= max(LEAST_TEXTS, LEAST_SHARE * p_size)).orderBy(F.col("n").desc(), "feature").limit(MOST_CANDIDATES)
    feature, n_pos = _array(top, "feature", "n")
    if not len(feature):
        return base
    order = np.argsort(feature.view(np.uint64))
    candidates, n_pos = feature.view(np.uint64)[order], n_pos[order].astype(float)

    feature, n_all = _array(_tally(docs, text_col, candidates), "feature", "n")
    in_all = np.zeros(len(candidates))
    in_all[np.searchsorted(candidates, feature.view(np.uint64))] = n_all
    size = float(docs.count())
    p, q = n_pos / max(1, p_size), (in_all + 1) / (size + 1)
    gain = (p - q) / np.sqrt(q * (1 - np.minimum(q, 0.999)) / max(1, p_size) + 1e-12)
    low = (n_pos - 2 * np.sqrt(n_pos)) / max(1, p_size)  # two standard errors below p
    good = np.flatnonzero((p >= LEAST_LIFT * q) & (low >= LEAST_LIFT / 1.5 * q))
    good = np.sort(good[np.argsort(-gain[good], kind="stable")][:MOST_FEATURES])
    features = candidates[good]
    if not len(features):
        return base

    others = docs.select(id_col).where(F.col(id_col).isNotNull()).distinct().orderBy(key).limit(MOST_UNLABELLED)
    sample = positives.select(id_col, F.lit(True).alias("toxic")).unionByName(others.select(id_col, F.lit(False).alias("toxic")))
    chosen = docs.join(F.broadcast(sample), id_col).select("toxic", text_col)  # bounded as above

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, places, values = _looked_up(batch.column(1), features)
            order = np.argsort(rows, kind="stable")
            edges = pa.array(np.searchsorted(rows[order], np.arange(batch.num_rows + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(edges, pa.array(x[order])) for x in (places, values)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], ["toxic", "places", "values"])

    table = chosen.mapInArrow(run, "toxic boolean, places array<bigint>, values array<double>").toArrow()
    toxic = table.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
    lists = table.column("places").combine_chunks()
    row, place = np.repeat(np.arange(len(toxic)), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy()
    value = table.column("values").combine_chunks().flatten().to_numpy()
    weights, bias = fit(row, place, value, toxic, len(features), prior)
    return Model(features, weights, bias)


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
          score_col: str = "score") -> DataFrame:
    """``keep`` columns of every row and ``score_col``; null and empty texts have no features.

    ``score_col`` must not be among ``keep``; other columns are left out.
    """
    return docs.select(*map(quoted, keep), probability(quoted(text_col), model).alias(score_col))


def probability(text: Column, model: Model) -> Column:
    """The score of each text; only texts go through Python, once."""

    def run(texts: pa.Array) -> pa.Array:
        rows, places, values = _looked_up(texts, model.features)
        z = np.bincount(rows, model.weights[places] * values, len(texts)) + model.bias
        return pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))))

    return F.arrow_udf(run, "double")(text)


def held_out(doc_id: Column) -> Column:
    """Rows no label of which is ever read: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def trained(docs: DataFrame, labels: DataFrame) -> Model:
    """The model for ``documents`` from the rows of ``labels`` that may be learnt from.

    Rows with a null label or held-out id are not read; an empty table gives a model
    without features, whose score is next to zero.
    """
    known = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull())
    share = known.agg(F.avg("toxic")).first()[0]
    return train(docs, known.where("toxic = 1"), float(share or 0))
