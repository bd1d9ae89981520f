"""Nearest neighbours by inner product with vantage-point trees, one per shard.

Inner product becomes a distance by one more coordinate that gives all vectors of
a shard the same length. A tree is searched for a block of queries at once; a
child is left out where the triangle inequality, with the query's own reach
divided by ``factor``, shows that it holds nothing nearer. Factor one is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labeltext.session import materialize

#: Vectors in a tree, in a leaf, and queries in a block.
SHARD_ROWS = 16_384
LEAF_ROWS = 256
BLOCK_ROWS = 2_048


def build(ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF_ROWS) -> dict:
    """A vantage-point tree. Nodes hold ``(vantage vector, radii of both sides, sides)``."""
    square = np.einsum("ij,ij->i", vectors, vectors)
    top = float(square.max())
    lifted = np.hstack([vectors, np.sqrt(np.maximum(top - square, 0))[:, None]])
    order, nodes = [], []

    def grow(rows: np.ndarray) -> int:
        at = len(nodes)
        nodes.append(None)
        if len(rows) <= leaf:
            start = sum(map(len, order))
            order.append(rows)
            nodes[at] = (start, start + len(rows))
            return at
        far = lifted[rows] - lifted[rows].mean(0)
        vantage = lifted[rows[np.argmax(np.einsum("ij,ij->i", far, far))]]
        diff = lifted[rows] - vantage
        apart = np.sqrt(np.einsum("ij,ij->i", diff, diff))
        by = np.argsort(apart, kind="stable")
        half = len(rows) // 2
        sides = [(by[:half], apart[by[:half]]), (by[half:], apart[by[half:]])]
        reach = [(float(d[0]), float(d[-1])) for _, d in sides]
        nodes[at] = (vantage, reach, [grow(rows[side]) for side, _ in sides])
        return at

    grow(np.arange(len(ids)))
    rows = np.concatenate(order)
    return {"ids": ids[rows], "vectors": vectors[rows], "top": top, "nodes": nodes}


def search(tree: dict, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float = 1.0):
    """``(query row, id, score)`` arrays: each query's ``k`` nearest in the tree, its own id left out.

    Scores that decide are summed in one fixed way, so equal vectors tie and the
    smaller id wins.
    """
    ids, vectors, nodes = tree["ids"], tree["vectors"], tree["nodes"]
    square = np.einsum("ij,ij->i", queries, queries)
    slack = 1e-9 * (1 + tree["top"] + square)
    best = np.full((len(queries), k), -np.inf)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def reach(rows: np.ndarray) -> np.ndarray:
        """How far away a vector may be and still be among the nearest so far."""
        return np.sqrt(np.maximum(square[rows] + tree["top"] - 2 * best[rows, 0] + slack[rows], 0))

    def visit(at: int, rows: np.ndarray) -> None:
        if not len(rows):
            return
        node = nodes[at]
        if len(node) == 2:
            score = queries[rows] @ vectors[node[0] : node[1]].T
            score[query_ids[rows][:, None] == ids[node[0] : node[1]][None, :]] = -np.inf
            near = score >= (best[rows, 0] - slack[rows])[:, None]
            near &= score > -np.inf
            q, v = np.nonzero(near)
            found.append((rows[q], node[0] + v, score[q, v]))
            both = np.hstack([best[rows], score])
            best[rows] = np.sort(np.partition(both, -k, axis=1)[:, -k:], axis=1)
            return
        vantage, sides, children = node
        inner = queries[rows] @ vantage[:-1]
        apart = np.sqrt(np.maximum(square[rows] + tree["top"] - 2 * inner, 0))
        # least distance to anything in each side
        least = [np.maximum(np.maximum(apart - hi, lo - apart), 0) for lo, hi in sides]
        first = (least[1] < least[0]).astype(int)
        tie = least[0] == least[1]
        first[tie] = (apart[tie] > (sides[0][1] + sides[1][0]) / 2).astype(int)
        for turn in (0, 1):
            side = first if turn == 0 else 1 - first
            gap = np.where(side == 0, least[0], least[1])
            open_ = factor * gap <= reach(rows) + 1e-9
            for s in (0, 1):
                visit(children[s], rows[open_ & (side == s)])

    visit(0, np.arange(len(queries)))
    if not found:
        return np.zeros(0, int), ids[:0], np.zeros(0)
    q, v, score = (np.concatenate(x) for x in zip(*found))
    keep = score >= best[q, 0] - slack[q]
    q, v = q[keep], v[keep]
    score = (queries[q] * vectors[v]).sum(1)
    order = np.lexsort((ids[v], -score, q))
    q, v, score = q[order], v[order], score[order]
    first = np.flatnonzero(np.r_[True, q[1:] != q[:-1]]) if len(q) else np.zeros(0, int)
    rank = np.arange(len(q)) - np.repeat(first, np.diff(np.r_[first, len(q)]))
    keep = rank < k
    return q[keep], ids[v[keep]], score[keep]


def _valid(vector: Column) -> Column:
    """Not null, not zero, and without null or non-finite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def _searched(k: int, factor: float, size: int):
    """A function for ``mapInArrow`` over rows ``(bucket, kind, id, vector)``, in order of the first two.

    Vectors (kind 0) of a bucket become trees of ``size`` at most; its queries (kind 1) come
    after them and are searched a block at a time, so a task holds one bucket.
    """
    block = BLOCK_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, trees = None, {}, {}

        def grown(dim: int) -> list[dict]:
            if dim in held:
                ids, vectors = (np.concatenate(x) for x in zip(*held.pop(dim)))
                trees[dim] = [build(ids[lo : lo + size], vectors[lo : lo + size]) for lo in range(0, len(ids), size)]
            return trees.get(dim, [])

        for batch in batches:
            bucket, kind, ids = (batch.column(i).to_numpy() for i in range(3))
            turns = np.flatnonzero((np.diff(bucket) != 0) | (np.diff(kind) != 0)) + 1
            for begin, stop in zip([0, *turns], [*turns, batch.num_rows]):
                if begin == stop:
                    continue
                if bucket[begin] != at:
                    at, held, trees = bucket[begin], {}, {}
                part = batch.column(3).slice(begin, stop - begin)
                sizes = np.diff(part.offsets.to_numpy())
                flat, start = part.flatten().to_numpy(), np.r_[0, np.cumsum(sizes)[:-1]]
                for dim in np.unique(sizes).tolist():
                    rows = np.flatnonzero(sizes == dim)
                    vectors, own = flat[start[rows][:, None] + np.arange(dim)], ids[begin:stop][rows]
                    if kind[begin] == 0:
                        held.setdefault(dim, []).append((own, vectors))
                        continue
                    for tree in grown(dim):
                        for lo in range(0, len(own), block):
                            q, near, score = search(tree, own[lo : lo + block], vectors[lo : lo + block], k, factor)
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(own[lo : lo + block][q]), pa.array(near), pa.array(score)], ["query_id", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int, factor: float = 1.0, id_col: str = "vec_id",
            vector_col: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest rows of ``vectors`` for each query.

    ``queries`` and ``vectors`` have ``id_col`` and ``vector_col``. A row with a
    null id or a vector that is null, zero or holds null or non-finite components
    takes no part; neither does the query's own id. Vectors of other dimensions
    are not compared. Every row is a candidate, also one that repeats; a query id
    that repeats is searched once, with its smallest vector. Fewer than ``k``
    candidates give fewer rows, no queries none.

    Vectors are written once and dealt evenly into buckets of about ``shard_rows``,
    a tree each; the queries go to every bucket, behind its vectors. All travel as
    rows of one vector, so what a batch or a task holds does not grow with the tables.
    """
    def clean(df: DataFrame) -> DataFrame:
        vector = F.col(vector_col).cast("array<double>")
        return df.select(F.col(id_col).cast("bigint").alias("id"), vector.alias("vector")).where(
            F.col("id").isNotNull() & _valid(F.col("vector")))

    # numbered as the written files are read, so the same row gets the same bucket again
    written = materialize(clean(vectors), "vectors")
    buckets = max(1, -(-written.count() // shard_rows))
    row = F.monotonically_increasing_id()
    dealt = written.select(F.pmod(row, F.lit(buckets)).cast("int").alias("bucket"), F.lit(0).alias("kind"), "id", "vector")
    asked = clean(queries).groupBy("id").agg(F.min("vector").alias("vector"))
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket")
    both = dealt.unionByName(asked.select(everywhere, F.lit(1).alias("kind"), "id", "vector"))
    placed = both.repartition(2 * buckets, "bucket").sortWithinPartitions("bucket", "kind")
    run = _searched(k, factor, 2 * shard_rows)
    hits = placed.mapInArrow(run, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
