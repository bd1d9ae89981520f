"""Ranked lexical search with norm buckets.

A document is a vector of impacts, one for each query term it has; a query weighs
terms. Both get the root of the weight, so the score is their inner product. Vectors are
ordered by length and cut into buckets. A bucket whose longest vector is too short for
a query's threshold (Cauchy-Schwarz) is skipped for it; inside a bucket the largest
impact of each coordinate bounds what a query's remaining terms can add, and vectors
that stay below the threshold drop out. What is left is scored again in integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labeltext.llm.textvec import words
from labeltext.session import materialize

#: Terms of the queries that are searched in one pass over the documents; more go in blocks.
BLOCK_TERMS = 16_384

#: Vectors in a bucket, and longest vectors from which queries get their first thresholds.
BUCKET, SEEDS = 2_048, 16_384

#: What sums in doubles may be short of the true bound, as a share.
SLACK = 1 - 1e-9


@dataclass
class Queries:
    """A block of queries over ``terms``, sorted term hashes."""

    terms: np.ndarray
    places: list[np.ndarray]  # terms of each query
    weights: np.ndarray  # of each term


def _distinct_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """``(item, terms)`` of the queries that have a term: 64-bit hashes, each once."""
    kind = items.schema[item_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words(batch.column(1), lower=True, pieces=True):
                h = part.hashes()
                sets = [np.unique(h[a:b]).view(np.int64) for a, b in zip(part.bounds, part.bounds[1:])]
                rows = [i for i, s in enumerate(sets) if len(s)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(part.first, part.rows).take(pa.array(rows, pa.int64())),
                    pa.array([sets[i] for i in rows], pa.list_(pa.int64()))], ["item", "terms"])

    return items.select(item_col, text_col).mapInArrow(run, f"item {kind}, terms array<bigint>")


def _term_counts(docs: DataFrame, id_col: str, text_col: str, terms: np.ndarray) -> DataFrame:
    """``(id, n, places, tf)`` per document: terms in all, and how often it has which of ``terms``."""
    low = np.uint64((1 << 20) - 1)
    maybe = np.zeros(1 << 20, bool)  # by the low bits: keeps most look-ups from a search
    maybe[(terms & low).astype(np.int64)] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in words(batch.column(1), lower=True, pieces=True):
                h, row = part.hashes(), part.row
                hit = np.flatnonzero(maybe[(h & low).astype(np.int64)])
                at = np.minimum(np.searchsorted(terms, h[hit]), len(terms) - 1)
                same = terms[at] == h[hit]
                pair, tf = np.unique(row[hit[same]] * len(terms) + at[same], return_counts=True)
                edges = pa.array(np.searchsorted(pair, np.arange(part.rows + 1) * len(terms)), pa.int32())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(part.first, part.rows), pa.array(np.diff(part.bounds).astype(np.int64)),
                    pa.ListArray.from_arrays(edges, pa.array((pair % len(terms)).astype(np.int32))),
                    pa.ListArray.from_arrays(edges, pa.array(tf.astype(np.int32)))], ["id", "n", "places", "tf"])

    named = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return named.mapInArrow(run, "id bigint, n bigint, places array<int>, tf array<int>")


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bounds, values)`` of a column of arrays."""
    bounds = column.offsets.to_numpy().astype(np.int64)
    return bounds - bounds[0], column.flatten().to_numpy(zero_copy_only=False)


def _holders(counts: DataFrame, width: int) -> np.ndarray:
    """How many documents hold each term: ``width`` numbers, whatever comes in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for batch in batches:
            total += np.bincount(_lists(batch.column(0))[1], minlength=width)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["place", "df"])

    rows = counts.select("places").mapInArrow(run, "place bigint, df bigint")
    table = rows.groupBy("place").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(width, np.int64)
    out[table.column("place").to_numpy()] = table.column("df").to_numpy()
    return out


def weight(n_docs: int, holders: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holders + 1)))


def _impacts(counts: DataFrame, n_docs: int, n_terms: int, weights: np.ndarray) -> DataFrame:
    """``(length, id, places, impacts)`` of the documents that have a term and an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds, places = _lists(batch.column(2))
            tf = _lists(batch.column(3))[1].astype(np.int64)
            sizes, which = np.unique(batch.column(1).to_numpy(), return_inverse=True)
            m = np.array([10 + 90 * int(n) * n_docs // n_terms for n in sizes], np.int64)[which]  # exact at any size
            row = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
            impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[row])
            length = np.sqrt(np.bincount(row, weights[places] * impact.astype(float) ** 2, batch.num_rows))
            yield pa.RecordBatch.from_arrays([
                pa.array(length), batch.column(0), batch.column(2),
                pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(impact.astype(np.int32)))],
                ["length", "id", "places", "impacts"])

    some = counts.where("size(places) > 0 and id is not null").select("id", "n", "places", "tf")
    return some.mapInArrow(run, "length double, id bigint, places array<int>, impacts array<int>")


class Bucket:
    """Some vectors in any order, also by term; a batch may hold the ends of several files."""

    def __init__(self, lengths: np.ndarray, ids: np.ndarray, bounds: np.ndarray, places: np.ndarray,
                 impacts: np.ndarray, width: int):
        self.lengths, self.ids, self.bounds, self.places, self.impacts = lengths, ids, bounds, places, impacts
        self.longest = lengths.max(initial=0.0)
        row = np.repeat(np.arange(len(ids)), np.diff(bounds))
        order = np.argsort(places, kind="stable")
        self.rows, self.by_term = row[order], impacts[order].astype(float)
        self.edges = np.r_[0, np.cumsum(np.bincount(places, minlength=width))]
        self.most = np.zeros(width)  # largest impact of each coordinate
        some = np.flatnonzero(np.diff(self.edges))
        if len(some):
            self.most[some] = np.maximum.reduceat(self.by_term, self.edges[some])

    def candidates(self, places: np.ndarray, weights: np.ndarray, least: int) -> np.ndarray:
        """Rows that may score ``least`` or more for the query ``places``."""
        w = weights[places]
        if math.sqrt(w.sum()) * self.longest < least * SLACK:
            return np.zeros(0, np.int64)  # Cauchy-Schwarz: no vector of the bucket is long enough
        bound = w * self.most[places]
        order = np.argsort(-bound, kind="stable")
        rest = np.r_[np.cumsum(bound[order][::-1])[::-1], 0.0]  # what the terms from here on can add
        focus = int(np.argmax(rest < max(least * SLACK, 0.5)))  # rows without these terms stay below
        score, squares = np.zeros(len(self.ids)), np.zeros(len(self.ids))
        for t in order[:focus]:
            lo, hi = self.edges[places[t]], self.edges[places[t] + 1]
            part = w[t] * self.by_term[lo:hi]
            score[self.rows[lo:hi]] += part
            squares[self.rows[lo:hi]] += part * self.by_term[lo:hi]
        left = np.sqrt(np.maximum(self.lengths**2 * (1 + 1e-9) - squares, 0))  # length over the other terms
        rest_norm = math.sqrt(w[order[focus:]].sum())
        most = score + np.minimum(rest[focus], rest_norm * left)
        return np.flatnonzero((score > 0) & (most >= least * SLACK))

    def scores(self, rows: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Exact scores of ``rows``; ``own``: the query's weight of every term, as integers."""
        n = self.bounds[rows + 1] - self.bounds[rows]
        at = np.repeat(self.bounds[rows] - np.cumsum(n) + n, n) + np.arange(n.sum())
        part = own[self.places[at]] * self.impacts[at].astype(np.int64)
        return np.add.reduceat(part, np.cumsum(n) - n) if len(rows) else np.zeros(0, np.int64)


def _search(vectors: DataFrame, queries: Queries, floor: np.ndarray, k: int) -> DataFrame:
    """``(query, id, score)``: what each task has of the ``k`` best of every query.

    ``vectors`` come longest first within each file, which prunes well; the result does not
    depend on it. ``floor``: a score that ``k`` documents are known to reach.
    """
    weights, width = queries.weights, len(queries.terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = np.maximum(floor, 1)
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in queries.places]
        own = np.zeros(width, np.int64)
        for batch in batches:
            lengths, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            (bounds, places), (_, impacts) = _lists(batch.column(2)), _lists(batch.column(3))
            for lo in range(0, batch.num_rows, BUCKET):
                hi = min(lo + BUCKET, batch.num_rows)
                cut = slice(bounds[lo], bounds[hi])
                bucket = Bucket(lengths[lo:hi], ids[lo:hi], bounds[lo : hi + 1] - bounds[lo], places[cut], impacts[cut], width)
                for q, at in enumerate(queries.places):
                    rows = bucket.candidates(at, weights.astype(float), least[q])
                    if not len(rows):
                        continue
                    own[at] = weights[at]
                    score = bucket.scores(rows, own)
                    own[at] = 0
                    good = score >= least[q]
                    score = np.concatenate([best[q][0], score[good]])
                    doc = np.concatenate([best[q][1], bucket.ids[rows[good]]])
                    top = np.lexsort((doc, -score))[:k]
                    best[q] = score[top], doc[top]
                    if len(top) == k:
                        least[q] = max(least[q], score[top[-1]])
        n = [len(s) for s, _ in best]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.arange(len(best)), n).astype(np.int32)), pa.array(np.concatenate([d for _, d in best])),
            pa.array(np.concatenate([s for s, _ in best]))], ["query", "id", "score"])

    return vectors.select("length", "id", "places", "impacts").mapInArrow(run, "query int, id bigint, score bigint")


def _floors(longest: DataFrame, queries: Queries, k: int) -> np.ndarray:
    """The ``k``-th best score of every query among ``longest``; 0 where there are fewer."""
    found = _search(longest, queries, np.zeros(len(queries.places), np.int64), k)
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc()))
    table = found.withColumn("place", place).where(F.col("place") == k).select("query", "score").toArrow()
    out = np.zeros(len(queries.places), np.int64)
    out[table.column("query").to_numpy()] = table.column("score").to_numpy()
    return out


def _ranked_block(docs: DataFrame, block: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame | None:
    spark = docs.sparkSession
    rows = block.toArrow()
    sets = [np.array(t, np.int64).view(np.uint64) for t in rows.column("terms").to_pylist()]
    if not sets:
        return None
    terms = np.unique(np.concatenate(sets))
    counts = materialize(_term_counts(docs, id_col, text_col, terms), "term-counts")
    n_docs, n_terms = counts.where("n > 0").agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return None
    weights = np.array([weight(n_docs, int(df)) for df in _holders(counts, len(terms))], np.int64)
    queries = Queries(terms, [np.searchsorted(terms, s) for s in sets], weights)

    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("length").desc(), F.col("id"), F.col("row")]  # the row splits ids that are repeated
    vectors = _impacts(counts, n_docs, n_terms, weights.astype(float)).withColumn("row", F.monotonically_increasing_id())
    vectors = materialize(vectors.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("row"), "impacts")
    share = max(0.0, 1 - SEEDS / n_docs)
    least = vectors.agg(F.percentile_approx("length", F.lit(share), F.lit(10_000))).first()[0]
    floors = _floors(vectors.where(F.col("length") >= F.lit(least)), queries, k) if least is not None else np.zeros(len(sets), np.int64)
    found = _search(vectors, queries, floors, k)

    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    kind = block.schema["item"].dataType.simpleString()
    names = spark.createDataFrame(list(enumerate(rows.column("item").to_pylist())), f"query int, item {kind}")
    return ranked.join(F.broadcast(names), "query")  # a block's queries, BLOCK_TERMS at most but for one long query


def search(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", block_terms: int = BLOCK_TERMS) -> DataFrame:
    """``(item, rank, id, score)``: the ``k`` best documents with a score above 0 of every row of ``items``.

    Terms are runs of ASCII letters, digits and all characters beyond ASCII, A-Z
    lower-cased, compared by 64-bit hashes. A term of weight ``w`` adds ``w`` times
    its impact once per query; ties go to the smaller id. Null and empty texts have
    no terms: such documents count for nothing and such items get no rows. Documents
    with a null id count in the statistics and are never returned; rows that share an
    id are ranked each, and so are items that share one. Other columns are not looked at.

    Documents are read once for each block of ``block_terms`` query terms. Vectors,
    not texts, are ordered; nothing that grows with the documents reaches the driver.
    """
    named = items.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))
    queries = materialize(_distinct_terms(named, "item", "text"), "queries")
    total = queries.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-int(total) // block_terms)
    own = F.pmod(F.xxhash64("terms"), F.lit(max(1, blocks)))
    found = [_ranked_block(docs, queries.where(own == i), k, id_col, text_col) for i in range(blocks)]
    kind = queries.schema["item"].dataType.simpleString()
    out = docs.sparkSession.createDataFrame([], f"item {kind}, rank int, id bigint, score bigint")
    if any(f is not None for f in found):
        out, *more = [f.select("item", "rank", "id", "score") for f in found if f is not None]
        for f in more:
            out = out.unionByName(f)
    return out.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")
