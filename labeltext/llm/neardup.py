"""Near-duplicate documents: an LSH forest proposes, full shingle sets decide.

Minhash signatures are sorted in several orders (rotations of the signature).
Neighbours of an order whose longest common prefix has DEPTH hashes or more are
candidates. Candidates form clusters, and within a cluster links are found exactly, in
one task. A join on the rarest shingles of each set finds all other links of rows
that the window does not settle: those of clusters too large for a task and of regions
with more rows than the window holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labeltext.llm.keyfilter import key_filter, rows_in
from labeltext.llm.names import free_name, quoted
from labeltext.llm.textvec import FEW_BYTES, Rolling, mix, words
from labeltext.session import materialize

#: Orders, and hashes that neighbours have to share at least: two sets that are 0.8
#: alike share no prefix in any order once in 1.7 million pairs.
ORDERS, DEPTH = 20, 3
HASHES = ORDERS * DEPTH

#: Rows before it in an order that a row is compared with (all of its region, unless it
#: is crowded; crowded rows are joined exactly), and the share of equal hashes from
#: which a pair is a candidate (five standard errors below 0.8).
WINDOW = 8
ALIKE = 0.55

#: Shingles in one task's block of a cluster. A larger cluster is cut into blocks in
#: ROUNDS ways, which link most of it cheaply; a join finds every link that is left.
BLOCK_SHINGLES = 4_000_000
ROUNDS = 3

#: Slots of the counts by which shingles are ordered in that join (they decide what it
#: costs, not what it finds), and rows of one shingle that are compared in one task.
SLOT_BITS = 22
CHUNK = 256

#: Edges of the candidate graph in one task of a round.
EDGES_PER_TASK = 500_000

_SEEDS = mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingle_sets(texts: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bounds, hashes)``: distinct shingles of each row, sorted, some rows at a time.

    A row with fewer than ``k`` words has one shingle of all of them, one without
    words none.
    """
    for part in words(texts, lower=True, chunk_bytes=FEW_BYTES):
        h = part.hashes()
        roll = Rolling(h, 0xD6E8FEB86659FD93)
        n = np.diff(part.bounds)
        count = np.where(n >= k, n - k + 1, (n > 0).astype(n.dtype))
        row = np.repeat(np.arange(part.rows), count)
        begin = np.cumsum(count) - count
        start = np.arange(len(row)) - begin[row] + part.bounds[row]
        shingles = roll.of(start, np.minimum(start + k, part.bounds[row + 1]))
        order = np.lexsort((shingles, row))
        row, shingles = row[order], shingles[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (shingles[1:] != shingles[:-1])
        row, shingles = row[new], shingles[new]
        yield part.first, np.searchsorted(row, np.arange(part.rows + 1)), shingles


def signatures(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """``(id, n, set_a, set_b, sig)`` per row: set size, digest of the set, minhashes."""
    kind = docs.schema[id_col].dataType.simpleString()
    xors, factors = _SEEDS[:HASHES], _SEEDS[HASHES:] | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, bounds, h in shingle_sets(batch.column(1), k):
                n = np.diff(bounds)
                some = np.flatnonzero(n)
                sig = np.zeros((len(n), HASHES), ">u4")
                a, b = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
                if len(some):
                    at = bounds[some]
                    for j in range(HASHES):
                        sig[some, j] = np.minimum.reduceat((h ^ xors[j]) * factors[j], at) >> np.uint64(32)
                    a[some] = np.add.reduceat(mix(h), at)
                    b[some] = np.add.reduceat(mix(h ^ xors[0]), at)
                raw = pa.py_buffer(sig.tobytes())
                offsets = pa.py_buffer((np.arange(len(n) + 1) * 4 * HASHES).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, len(n)), pa.array(n.astype(np.int64)), pa.array(a.view(np.int64)),
                    pa.array(b.view(np.int64)), pa.Array.from_buffers(pa.binary(), len(n), [None, offsets, raw]),
                ], [id_col, "n", "set_a", "set_b", "sig"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n bigint, set_a bigint, set_b bigint, sig binary")


def _region_keys(reps: DataFrame) -> DataFrame:
    """``(region, id)``: a row per order; a region is an order with its first DEPTH hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), ">u4").reshape(-1, ORDERS, DEPTH).astype(np.uint64)
            key = np.full(sig.shape[:2], 1, np.uint64) * np.arange(1, ORDERS + 1, dtype=np.uint64)
            for j in range(DEPTH):
                key = mix(key * np.uint64(0x100000001B3) + sig[:, :, j])
            ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), ORDERS)
            tree = np.tile(np.arange(ORDERS, dtype=np.int32), batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.ravel().view(np.int64)), pa.array(tree), pa.array(ids)], ["region", "tree", "id"])

    return reps.select("id", "sig").mapInArrow(run, "region bigint, tree int, id bigint")


def _forest(links: list[tuple[int, int]], root: dict[int, int]):
    """Those of ``links`` that join two parts of ``root``, which is brought up to date."""
    def find(x: int) -> int:
        top = x
        while root.get(top, top) != top:
            top = root[top]
        while root.get(x, x) != top:
            root[x], x = top, root[x]
        return top

    for a, b in links:
        x, y = find(a), find(b)
        if x != y:
            root[max(x, y)] = min(x, y)
            yield a, b


def regions(reps: DataFrame) -> DataFrame:
    """``(region, tree, id, crowded)`` of regions with more rows than one; crowded: more than the window holds."""
    keys = materialize(_region_keys(reps), "regions")
    sizes = keys.groupBy("region").agg(F.count("*").alias("c")).where("c > 1")
    sizes = materialize(sizes.select("region", (F.col("c") > WINDOW + 1).alias("crowded")), "sizes")
    return materialize(keys.join(sizes, "region"), "shared")


def candidates(reps: DataFrame, shared: DataFrame) -> DataFrame:
    """``(a, b)``: pairs of ids that connect all neighbours that look alike.

    ``shared`` is ``regions(reps)``. A region that is not crowded stays in one task, and
    all its pairs are looked at; a crowded one is sorted over tasks.
    """
    held = shared.join(reps.select("id", "sig"), "id")
    # the signature from the order's own hashes on, low byte of each hash: sorts by deeper prefixes
    turned = F.expr(
        f"concat(substring(sig, tree * {4 * DEPTH} + 1, {4 * HASHES}), substring(sig, 1, tree * {4 * DEPTH}))")
    held = held.select("region", turned.alias("sig"), "id", "crowded")
    parts = max(1, int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    columns = ["region", "sig", "id"]
    whole = held.where("not crowded").select(columns).repartition(parts, "region").sortWithinPartitions(columns)
    ordered = held.where("crowded").select(columns).repartitionByRange(parts, *columns).sortWithinPartitions(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_region, last_sig, last_id = np.zeros(0, np.int64), np.zeros((0, HASHES), np.uint32), np.zeros(0, np.int64)
        root: dict[int, int] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, HASHES)
            region = np.concatenate([last_region, batch.column(0).to_numpy()])
            sig, ids = np.concatenate([last_sig, sig]), np.concatenate([last_id, batch.column(2).to_numpy()])
            links = []
            for back in range(1, WINDOW + 1):
                here = np.arange(max(back, len(last_id)), len(ids))
                here = here[region[here] == region[here - back]]
                near = (sig[here] == sig[here - back]).sum(1) >= ALIKE * HASHES
                links += zip(ids[here[near] - back].tolist(), ids[here[near]].tolist())
            pairs = list(_forest(links, root))
            if len(root) > 1_000_000:
                root.clear()  # costs repeated pairs only
            last_region, last_sig, last_id = region[-WINDOW:], sig[-WINDOW:], ids[-WINDOW:]
            if pairs:
                a, b = np.array(pairs, np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    found = whole.mapInArrow(run, "a bigint, b bigint").unionByName(ordered.mapInArrow(run, "a bigint, b bigint"))
    return found.distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(id, component)`` of every id in ``edges (a, b)``: the smallest id it is connected with.

    Alternating large and small stars: each round every node hands its larger, then
    its smaller neighbours to the smallest one it knows, until nothing changes.
    Rounds grow with the logarithm of the longest path; every round is written, so
    a lost executor costs a read.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = materialize(edges, "edges")
    before = None
    while True:
        n = before[0] if before else edges.count()
        parts = n // EDGES_PER_TASK + 1  # few edges need few files
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")).coalesce(parts), "stars")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.where("u <> v").distinct().coalesce(parts), "edges")
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")).coalesce(parts), "stars")
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct().coalesce(parts), "edges")
        now = edges.agg(F.count("*"), F.sum(F.expr("xxhash64(u, v) & 4294967295"))).first()
        if now == before:
            break
        before = now
    inner = edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return inner.unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def link_set(ids: np.ndarray, bounds: np.ndarray, h: np.ndarray, share: int) -> np.ndarray:
    """The smallest id each of some documents is linked with, directly or not.

    ``h[bounds[i] : bounds[i + 1]]`` is the set of document ``i``. Documents are taken
    one after another from those reached; each is compared, through the shingles
    it has, with those not reached yet, so copies of one text cost one pass.
    """
    n = np.diff(bounds)
    out = np.arange(len(ids))
    if len(ids) == 2:
        both = len(np.intersect1d(h[: bounds[1]], h[bounds[1] :], assume_unique=True))
        linked = 100 * both >= share * (n.sum() - both)
        return np.full(2, ids.min()) if linked else ids
    order = np.argsort(h, kind="stable")
    post, owner = h[order], np.repeat(out, n)[order]
    open_ = np.ones(len(ids), bool)
    for first in range(len(ids)):
        if not open_[first]:
            continue
        open_[first] = False
        queue, group = [first], [first]
        while queue and open_.any():
            x = queue.pop()
            own = h[bounds[x] : bounds[x + 1]]
            lo, hi = np.searchsorted(post, own, "left"), np.searchsorted(post, own, "right")
            size = hi - lo
            at = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())
            met = owner[at]
            both = np.bincount(met[open_[met]], minlength=len(ids))
            linked = np.flatnonzero(open_ & (both > 0) & (100 * both >= share * (n + n[x] - both)))
            open_[linked] = False
            queue += linked.tolist()
            group += linked.tolist()
            if 4 * len(owner) > 1_000_000 and open_.sum() * 4 < len(np.unique(owner)):
                keep = open_[owner]
                post, owner = post[keep], owner[keep]
        out[group] = np.array(group)[np.argmin(ids[group])]
    return ids[out]


def _linked(members: DataFrame, k: int, share: int) -> DataFrame:
    """``(a, b)``: each id of ``members (block, id, text)`` with the smallest it is linked with in its block."""
    parts = max(1, int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = members.select("block", "id", "text").repartition(parts, "block").sortWithinPartitions("block", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, np.ndarray]] = []
        block = None

        def done():
            if len(held) < 2:
                return []
            ids = np.array([i for i, _ in held], np.int64)
            sets = [s for _, s in held]
            bounds = np.r_[0, np.cumsum([len(s) for s in sets])]
            return list(zip(ids.tolist(), link_set(ids, bounds, np.concatenate(sets), share).tolist()))

        for batch in batches:
            blocks, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            out = []
            for first, bounds, h in shingle_sets(batch.column(2), k):
                for i in range(len(bounds) - 1):
                    if blocks[first + i] != block:
                        out += done()
                        held, block = [], blocks[first + i]
                    held.append((ids[first + i], h[bounds[i] : bounds[i + 1]].copy()))
            if out:
                a, b = np.array(out, np.int64).T
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
        if out := done():
            a, b = np.array(out, np.int64).T
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return ordered.mapInArrow(run, "a bigint, b bigint")


def _sets(members: DataFrame, k: int) -> DataFrame:
    """``(id, label, h)`` of ``members (id, label, text)``: sorted distinct shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, bounds, h in shingle_sets(batch.column(2), k):
                rows = len(bounds) - 1
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, rows), batch.column(1).slice(first, rows), lists], ["id", "label", "h"])

    return members.select("id", "label", "text").mapInArrow(run, "id bigint, label bigint, h array<bigint>")


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bounds, hashes)`` of a column of arrays."""
    bounds = column.offsets.to_numpy().astype(np.int64)
    return bounds - bounds[0], column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)


def _slot(h: np.ndarray) -> np.ndarray:
    return (mix(h) >> np.uint64(64 - SLOT_BITS)).astype(np.int32)


def _levels(sets: DataFrame) -> np.ndarray:
    """How common the shingles of each slot are, as bits of their count: 4 MB whatever comes in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot, n = np.unique(_slot(_lists(batch.column(0))[1]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(n.astype(np.int64))], ["slot", "n"])

    table = sets.select("h").mapInArrow(run, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << SLOT_BITS, np.uint8)
    out[table.column("slot").to_numpy()] = np.frexp(table.column("n").to_numpy().astype(float))[1]
    return out


def _prefix_keys(sets: DataFrame, levels: np.ndarray, share: int) -> DataFrame:
    """``(key, id, label, n, place)``: the rarest shingles of each set, as many as a link needs one of.

    Of two linked sets, the shingle that comes first among those they share is in both
    prefixes: at least ``share`` percent of a set are shared.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds, h = _lists(batch.column(2))
            n = np.diff(bounds)
            row = np.repeat(np.arange(len(n)), n)
            h = h[np.lexsort((h, levels[_slot(h)], row))]
            place = np.arange(len(h)) - bounds[row]
            keep = np.flatnonzero(place <= n[row] + -share * n[row] // 100)
            row = row[keep]
            ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[keep].view(np.int64)), pa.array(ids[row]), pa.array(labels[row]), pa.array(n[row]), pa.array(place[keep])],
                ["key", "id", "label", "n", "place"])

    return sets.select("id", "label", "h").mapInArrow(run, "key bigint, id bigint, label bigint, n bigint, place bigint")


def _prefix_pairs(keys: DataFrame, share: int) -> DataFrame:
    """``(a, b)``: ids with different labels that share a key and may be linked by their sizes and places.

    Rows of a key are dealt over chunks, and each two chunks meet in one block, so a
    common key is spread over tasks. Keys whose rows are all linked already are left out.
    """
    live = keys.groupBy("key").agg(F.count("*").alias("c"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    live = live.where("c > 1 and lo <> hi").select("key", F.ceil(F.col("c") / CHUNK).alias("chunks"))
    held = keys.join(live, "key").withColumn("part", F.pmod(F.xxhash64("id"), F.col("chunks")))
    held = held.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)))
    held = held.select(
        F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other")).alias("block"),
        "part", (F.col("part") != F.col("other")).alias("cross"), "id", "label", "n", "place")
    parts = max(1, int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = held.repartition(parts, "block").sortWithinPartitions("block")

    def close(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        block, part, cross, ids, label, n, place = columns
        left = n - place
        found = [np.zeros((0, 2), np.int64)]
        i, back = np.arange(len(block)), 0
        while len(i):
            back += 1
            i = i[i + back < len(block)]
            i = i[block[i] == block[i + back]]
            j = i + back
            ok = (label[i] != label[j]) & (~cross[i] | (part[i] != part[j]))
            ok &= 100 * np.minimum(n[i], n[j]) >= share * np.maximum(n[i], n[j])
            ok &= (100 + share) * np.minimum(left[i], left[j]) >= share * (n[i] + n[j])
            found.append(np.stack([np.minimum(ids[i], ids[j])[ok], np.maximum(ids[i], ids[j])[ok]], 1))
        pairs = np.concatenate(found)
        return np.unique(pairs, axis=0).T if len(pairs) else pairs.T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held = now if held is None else [np.concatenate(x) for x in zip(held, now)]
            last = np.searchsorted(held[0], held[0][-1])  # the block that may go on
            a, b = close([c[:last] for c in held])
            held = [c[last:] for c in held]
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
        if held is not None:
            a, b = close(held)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return ordered.mapInArrow(run, "a bigint, b bigint").distinct()


def _joined_links(members: DataFrame, k: int, share: int) -> DataFrame:
    """``(a, b)``: all links between ids of ``members (id, label, text)`` that have different labels."""
    sets = materialize(_sets(members, k), "sets")
    keys = materialize(_prefix_keys(sets, _levels(sets), share), "keys")
    pairs = materialize(_prefix_pairs(keys, share), "pairs")
    one = sets.select(F.col("id").alias("a"), F.col("h").alias("of_a"))
    two = sets.select(F.col("id").alias("b"), F.col("h").alias("of_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (at, x), (to, y) = _lists(batch.column(2)), _lists(batch.column(3))
            linked = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                first, second = x[at[i] : at[i + 1]], y[to[i] : to[i + 1]]
                both = len(np.intersect1d(first, second, assume_unique=True))
                linked[i] = 100 * both >= share * (len(first) + len(second) - both)
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(linked)) for c in batch.columns[:2]], ["a", "b"])

    return pairs.join(one, "a").join(two, "b").select("a", "b", "of_a", "of_b").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                    share: int = 80, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """``(id, n_shingles, component_id, kept)`` for every row of ``docs``.

    Documents are linked if ``100 * intersection >= share * union`` of their sets of
    ``k``-word shingles (A-Z lower-cased; fewer words make one shingle). Texts that
    are null or have no words have an empty set and are linked with nothing. A row
    with a null id takes no part: its component is null and it is kept. Rows that
    share an id count as one document in each of their sets. Ids are integers.

    Equal sets become one class before anything else, so copies cost a row per
    task. Signatures, not texts, are sorted; only texts in a cluster of candidates
    or in a crowded region are compared. ``share`` under 80 would need more orders than ORDERS.
    """
    named = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    sigs = materialize(signatures(named, "id", "text", k), "signatures")
    classes = sigs.where("n > 0 and id is not null").groupBy("set_a", "set_b").agg(
        F.min("id").alias("id"), F.first("sig").alias("sig"), F.first("n").alias("n"))
    reps = materialize(classes, "classes")
    shared = regions(reps)
    pairs = materialize(candidates(reps, shared), "candidates")
    clusters = materialize(components(pairs), "clusters")

    # a cluster is one block, or as many as its shingles need
    sizes = clusters.join(reps.select("id", "n"), "id").groupBy("component").agg(F.sum("n").alias("total"))
    large = materialize(sizes.where(F.col("total") > block_shingles), "large")
    block = clusters.join(large, "component", "left_anti").select("id", F.col("component").alias("block"))
    wide = clusters.join(large, "component").withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(ROUNDS))))
    place = F.pmod(F.xxhash64("id", "round"), F.ceil(F.col("total") / block_shingles))
    block = block.unionByName(wide.select("id", F.xxhash64("component", "round", place).alias("block")))
    # only texts of clusters are shuffled, and they are at any size
    block = materialize(block, "blocks")
    inside = key_filter(block.select(F.col("id").alias("key")))
    texts = rows_in(named.where("id is not null"), "id", inside)
    chosen = block.hint("merge").join(texts, "id")
    links = materialize(_linked(chosen.select("block", "id", "text"), k, share), "links")
    open_ = clusters.join(large, "component", "left_semi").select("id").unionByName(shared.where("crowded").select("id"))
    open_ = materialize(open_.distinct(), "open")
    if open_.take(1):
        found = materialize(components(links), "linked")
        labelled = open_.join(found, "id", "left").select("id", F.coalesce("component", "id").alias("label"))
        texts = rows_in(named.where("id is not null"), "id", key_filter(open_.select(F.col("id").alias("key"))))
        more = materialize(_joined_links(labelled.hint("merge").join(texts, "id"), k, share), "joined")
        found = components(links.unionByName(more))
    else:
        found = links.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component"))
    found = found.withColumnRenamed("id", "rep")

    own = reps.select("set_a", "set_b", F.col("id").alias("rep")).join(found, "rep", "left").select(
        "set_a", "set_b", F.coalesce("component", "rep").alias("component"))
    rows = sigs.select("id", "n", "set_a", "set_b").join(own, ["set_a", "set_b"], "left")
    component = F.when(F.col("id").isNotNull(), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")))
    return rows.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """``docs`` without the rows that ``near_duplicates`` does not keep; all columns stay.

    Rows that are surely kept are told by a filter of the dropped ids and not
    shuffled; the few others are compared with these ids by a join.
    """
    marked = near_duplicates(docs, id_col, text_col, **settings)
    dropped = materialize(marked.where("not kept").select(F.col(id_col).cast("bigint").alias("key")).distinct(), "dropped")
    bits = key_filter(dropped)
    own = quoted(id_col).cast("bigint")
    sure, open_ = rows_in(docs, own, bits, inside=False), rows_in(docs, own, bits)
    mark = free_name("key", docs.columns)
    left = open_.join(dropped.withColumnRenamed("key", mark), own == F.col(mark), "left_anti")
    return sure.unionByName(left)
