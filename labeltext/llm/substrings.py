"""Repeated passages found by restricted recompression.

Rounds name runs and pairs of symbols, words at first, by the content they stand
for, so equal passages get equal symbols everywhere but near their ends, without
any exchange between tasks. Symbols stay short, which bounds how far the ends
reach: of every WINDOW words that occur twice, the same symbols begin inside. Some
of these beginnings are anchors. Anchors shared by two documents reveal what may
be repeated; digests of whole stretches and of single windows then verify it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labeltext.llm.keyfilter import key_filter, member
from labeltext.llm.textvec import Rolling, mix, words
from labeltext.session import materialize

#: Words of a window, and of an anchor's name.
WINDOW, NAME = 50, 16

#: Most words of a symbol, by round. A round loses at most ``cap - 1`` words at either
#: end to runs and as many to pairs.
CAPS = (2, 3)
LOSS = 2 * sum(c - 1 for c in CAPS)

#: In every so many positions one anchor is chosen; they fit into what is left.
SPAN = WINDOW - 2 * LOSS - NAME + 1

_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_ODD = np.uint64(0x9FB21C651E98DF25)


def symbols(names: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """First words of the symbols left after all rounds over words of several documents."""
    start = np.arange(len(names))
    for turn, cap in enumerate(CAPS):
        # runs of one symbol become one, if that stays short
        last = np.append(start[1:], len(owner))
        size = last - start
        new = np.ones(len(names), bool)
        new[1:] = (names[1:] != names[:-1]) | (owner[start[1:]] != owner[start[:-1]])
        head = np.flatnonzero(new)
        count = np.diff(np.append(head, len(names)))
        fits = (count > 1) & (size[head] * count <= cap)
        joined = np.repeat(fits, count)
        named = names.copy()
        named[head[fits]] = mix(names[head[fits]] * _ODD + count[fits].astype(np.uint64))
        keep = new | ~joined
        names, start = named[keep], start[keep]
        # a left and a right symbol, told apart by a bit of the name, become one
        size = np.append(start[1:], len(owner)) - start
        left = (mix(names + np.uint64(turn + 1)) >> np.uint64(63)).astype(bool)
        pair = left[:-1] & ~left[1:] & (owner[start[:-1]] == owner[start[1:]]) & (size[:-1] + size[1:] <= cap)
        at = np.flatnonzero(pair)
        named = names.copy()
        named[at] = mix(names[at] * _ODD + mix(names[at + 1]))
        keep = np.ones(len(names), bool)
        keep[at + 1] = False
        names, start = named[keep], start[keep]
    return start


def _sliding(v: np.ndarray, n: int, f, fill) -> np.ndarray:
    """``f`` over ``v[i : i + n]`` for every ``i``, with ``fill`` after the end."""
    have = 1
    while have < n:
        step = min(have, n - have)
        v = f(v, np.append(v[step:], np.full(step, fill, v.dtype))[: len(v)])
        have += step
    return v


class Parsed:
    """Words, anchors and stretches of some rows."""

    def __init__(self, part):
        self.part, self.bounds, self.owner = part, part.bounds, part.row
        self.hashes = part.hashes()
        self.rolls = [Rolling(self.hashes, base) for base in _BASES]
        n, w = len(self.hashes), np.arange(len(self.hashes))
        ends = self.bounds[1:][self.owner]
        self.windows = np.flatnonzero(w + WINDOW <= ends)  # all starts
        top = np.iinfo(np.uint64).max
        value = np.full(n, top, np.uint64)
        at = symbols(self.hashes, self.owner) if n else w
        at = at[at + NAME <= ends[at]]
        value[at] = self.rolls[0].of(at, at + NAME) >> np.uint64(1)
        least = _sliding(value, SPAN, np.minimum, top)
        least[w + SPAN + NAME - 1 > ends] = 0
        # chosen: the least of one of the spans it lies in
        best = _sliding(least[::-1], SPAN, np.maximum, 0)[::-1]
        self.anchors = np.flatnonzero((value == best) & (value < top) & (ends - self.bounds[:-1][self.owner] >= WINDOW))
        self.names = value[self.anchors]

    def digest(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.rolls[0].of(start, end), self.rolls[1].of(start, end)

    def rows(self) -> np.ndarray:
        """A digest of each row's words."""
        return self.rolls[1].of(self.bounds[:-1], self.bounds[1:])

    def suspects(self, shared: np.ndarray) -> np.ndarray:
        """Which window starts lie round an anchor with a name in the filter ``shared``."""
        p = self.anchors[member(shared, self.names)]
        first = np.maximum(p + NAME - WINDOW, self.bounds[:-1][self.owner[p]])
        edge = np.zeros(len(self.hashes) + 1, np.int64)
        np.add.at(edge, first, 1)
        np.add.at(edge, p + 1, -1)
        return np.cumsum(edge[:-1])[self.windows] > 0

    def stretches(self, suspect: np.ndarray):
        """``(first, last, which)``: window starts up to each anchor, and which windows they are.

        Only stretches with a suspect window; ``which`` gives each window its stretch.
        """
        to = np.searchsorted(self.anchors, self.windows)
        new = np.ones(len(to), bool)
        new[1:] = to[1:] != to[:-1]
        which = np.cumsum(new) - 1
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(to)) - 1
        held = np.zeros(len(head), bool)
        held[which[suspect]] = True
        number = np.cumsum(held) - 1
        return self.windows[head[held]], self.windows[tail[held]], np.where(held[which], number[which], -1)


def _scan(docs: DataFrame, emit, schema: str) -> DataFrame:
    """``emit(parsed, ids)`` over all rows of ``docs (id, text)``: arrays of ``schema``'s columns."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for part in words(batch.column(1)):
                parsed = Parsed(part)
                columns = emit(parsed, ids[part.first : part.first + part.rows])
                columns = [c.view(np.int64) if c.dtype == np.uint64 else c for c in columns]
                if len(columns[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    return docs.select("id", "text").mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   keep_text: bool = True) -> DataFrame:
    """``(id, n_words, n_removed, kept, kept_sha256)`` for every row of ``docs``.

    Every word covered by a window of WINDOW words of one document is removed, if
    the same window also begins in a document with a smaller id; windows are those
    of the input. ``kept`` (left out if not ``keep_text``) joins the other words by
    a space. Null and empty texts have no words. Rows with a null id lose nothing
    and prove nothing; rows with one id never make each other repeats. Ids are
    integers; columns other than the two named are not read.

    Passes over the texts: anchors; stretches round shared anchors; windows of the
    stretches of the smallest documents that hold them; the result. Between them
    travel names and digests, once each, and copies are combined on the map side.
    """
    every = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    named = every.where("id is not null")

    def anchors(p: Parsed, ids: np.ndarray):
        own = np.unique(np.stack([p.owner[p.anchors].astype(np.uint64), p.names]), axis=1) if len(p.names) else np.zeros((2, 0), np.uint64)
        return own[1], ids[own[0].astype(np.int64)]

    names = _scan(named, anchors, "name bigint, id bigint").groupBy("name").agg(F.min("id").alias("a"), F.max("id").alias("b"))
    shared = key_filter(materialize(names.where("a < b").select(F.col("name").alias("key")), "names"))

    def stretches(p: Parsed, ids: np.ndarray):
        first, last, _ = p.stretches(p.suspects(shared))
        a, b = p.digest(first, last + WINDOW)
        row = p.owner[first]
        return a, b, ids[row], p.rows()[row]

    found = materialize(_scan(named, stretches, "a bigint, b bigint, id bigint, seq bigint"), "stretches")
    least = materialize(found.groupBy("a", "b").agg(F.min("id").alias("least")), "least")
    settled = found.join(least, ["a", "b"]).where("id > least").select("id", "seq", F.col("a").alias("mark"))

    # windows matter in the smallest document of a stretch only: it has all of them
    chosen = key_filter(least.select(F.expr("a ^ least").alias("key")))

    def windows(p: Parsed, ids: np.ndarray):
        first, last, which = p.stretches(p.suspects(shared))
        a, _ = p.digest(first, last + WINDOW)
        open_ = member(chosen, a ^ ids[p.owner[first]].astype(np.uint64)) if len(a) else np.zeros(0, bool)
        at = p.windows[(which >= 0) & open_[which]] if len(a) else p.windows[:0]
        a, b = p.digest(at, at + WINDOW)
        row = p.owner[at]
        return a, b, ids[row], p.rows()[row], at - p.bounds[row]

    each = _scan(named, windows, "a bigint, b bigint, id bigint, seq bigint, at bigint")
    each = materialize(each, "windows")
    first = each.groupBy("a", "b").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    first = materialize(first, "repeats")
    single = each.join(first, ["a", "b"]).where("id > least").select("id", "seq", "at")

    marks = settled.select("id", F.struct("seq", "mark", F.lit(-1).cast("bigint").alias("at")).alias("x")).unionByName(
        single.select("id", F.struct("seq", F.lit(0).cast("bigint").alias("mark"), "at").alias("x")))
    marks = marks.groupBy("id").agg(F.collect_set("x").alias("marks"))  # no more than a document has windows
    joined = every.join(marks, "id", "left").select("id", "text", "marks.seq", "marks.mark", "marks.at")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seqs, marked, ats = (c.to_pylist() for c in batch.columns[2:])
            for part in words(batch.column(1)):
                p = Parsed(part)
                lo = part.first
                gone = np.zeros(len(p.hashes) + 1, np.int64)
                some = [i for i in range(part.rows) if seqs[lo + i]]
                if some:
                    which = np.searchsorted(p.anchors, p.windows)
                    new = np.ones(len(which), bool)
                    new[1:] = which[1:] != which[:-1]
                    head = np.flatnonzero(new)
                    begin = p.windows[head]
                    end = p.windows[np.append(head[1:], len(which)) - 1] + WINDOW if len(head) else begin
                    digest = p.digest(begin, end)[0].view(np.int64)
                    own = p.rows().view(np.int64)
                for i in some:
                    mine = np.array(seqs[lo + i]) == own[i]
                    at, mark = np.array(ats[lo + i])[mine], np.array(marked[lo + i])[mine]
                    s, t = np.searchsorted(begin, p.bounds[i : i + 2])
                    hit = np.arange(s, t)[np.isin(digest[s:t], mark[at < 0])]
                    np.add.at(gone, begin[hit], 1)
                    np.add.at(gone, end[hit], -1)
                    at = at[at >= 0] + p.bounds[i]
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + WINDOW, -1)
                gone = np.cumsum(gone[:-1]) > 0
                data, kept, removed = part.data.tobytes(), [], []
                for i in range(part.rows):
                    s, t = p.bounds[i : i + 2]
                    if gone[s:t].any():
                        stay = np.flatnonzero(~gone[s:t]) + s
                        kept.append(b" ".join([data[x:y] for x, y in zip(part.start[stay].tolist(), part.end[stay].tolist())]))
                    elif t > s:
                        kept.append(b" ".join(data[part.start[s] : part.end[t - 1]].split()))
                    else:
                        kept.append(b"")
                    removed.append(int(gone[s:t].sum()))
                columns = [batch.column(0).slice(lo, part.rows), pa.array(np.diff(p.bounds).astype(np.int64)), pa.array(removed, pa.int64())]
                columns += [pa.array([k.decode() for k in kept])] * keep_text
                columns += [pa.array([hashlib.sha256(k).hexdigest() for k in kept])]
                yield pa.RecordBatch.from_arrays(columns, [id_col, "n_words", "n_removed", *["kept"] * keep_text, "kept_sha256"])

    schema = f"`{id_col}` bigint, n_words bigint, n_removed bigint" + ", kept string" * keep_text + ", kept_sha256 string"
    return joined.mapInArrow(finish, schema)
