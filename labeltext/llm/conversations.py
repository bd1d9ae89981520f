"""Repair of the turn structure of conversations by branch and bound.

A conversation is right if its roles are an optional system turn and then one or more
pairs of user and assistant, or if it is empty. Rows can be kept, given another role
or deleted, and empty turns can be inserted; the cheapest repair, and among those the
one whose letters (D, I, K, R) come first, is found by a depth-first search.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labeltext.session import materialize

#: What edits cost, and what an undeleted truncated row adds.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

#: Classes of rows by the initial of their role; any other initial is 3.
SYSTEM, USER, ASSISTANT, OTHER = range(4)

#: First fault of a row.
SOUND, BLANK, DUPLICATE, CUT_OFF = range(4)

#: States of a repaired prefix: empty, system, ends with user, ends with assistant.
#: The state that each class leads to (none: -1), and what an insertion or a new role gives.
KEPT = ((1, 2, -1, -1), (-1, 2, -1, -1), (-1, -1, 3, -1), (-1, 2, -1, -1))
FORCED = (2, 2, 3, 2)
ENDS = (True, False, False, True)

WHITE = " \t\n\x0b\x0c\r"


def suffix_bounds(codes: bytes) -> list[tuple[int, int, int, int]]:
    """For every row and state, a lower bound of what the rows from there on cost.

    A code is ``class + 4 * fault``. The bounds are met by some repair, so that the
    search never leaves the cheapest ones.
    """
    far = 1 << 60
    after = [0 if ok else far for ok in ENDS]
    out = [(0, 0, 0, 0)] * (len(codes) + 1)
    for i in range(len(codes), -1, -1):
        if i < len(codes):
            kind, fault = codes[i] & 3, codes[i] >> 2
            now = [DELETE + x for x in after]
            if fault in (SOUND, CUT_OFF):
                more = TRUNCATED if fault == CUT_OFF else 0
                for q in range(4):
                    now[q] = min(now[q], REROLE + more + after[FORCED[q]])
                    if KEPT[q][kind] >= 0:
                        now[q] = min(now[q], more + after[KEPT[q][kind]])
            after = now
        u, a = min(after[2], INSERT + after[3]), min(after[3], INSERT + after[2])  # with insertions first
        after = [min(after[0], INSERT + u), min(after[1], INSERT + u), u, a]
        out[i] = tuple(after)
    return out


def cheapest(codes: bytes) -> tuple[int, str]:
    """``(cost, audit)`` of the best repair.

    The stack holds prefixes; the one with the lowest bound, then the first letter, is
    taken next. A prefix is given up if its bound exceeds the incumbent's cost or if its
    state was reached as cheaply before: those that cost the same come in order of
    their letters, so what came first is no worse. An empty stack proves the rest.
    """
    bounds = suffix_bounds(codes)
    reached = [1 << 60] * (4 * len(bounds))  # per row and state: the least cost of a prefix
    best: tuple[int, bytes] | None = None
    path = bytearray()
    stack = [(0, 0, 0, 0, 0)]  # rows done, state, cost, letters before, letter
    while stack:
        i, q, cost, depth, letter = stack.pop()
        if best and cost + bounds[i][q] > best[0] or reached[4 * i + q] <= cost:
            continue
        reached[4 * i + q] = cost
        del path[depth:]
        if letter:
            path.append(letter)
        if i == len(codes) and ENDS[q] and (best is None or (cost, path) < best):
            best = cost, bytes(path)
        moves = [(cost + INSERT, b"I"[0], i, FORCED[q])]
        if i < len(codes):
            kind, fault = codes[i] & 3, codes[i] >> 2
            moves.append((cost + DELETE, b"D"[0], i + 1, q))
            if fault in (SOUND, CUT_OFF):
                more = cost + (TRUNCATED if fault == CUT_OFF else 0)
                moves.append((more + REROLE, b"R"[0], i + 1, FORCED[q]))
                if KEPT[q][kind] >= 0:
                    moves.append((more, b"K"[0], i + 1, KEPT[q][kind]))
        limit = best[0] if best else 1 << 59
        moves = sorted((c + bounds[j][s], x, c, j, s) for c, x, j, s in moves)
        stack += [(j, s, c, len(path), x) for f, x, c, j, s in reversed(moves) if f <= limit]
    return best[0], best[1].decode()


class Repaired:
    """The digest of a conversation's repaired rows, fed row by row."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, 0
        self.digest, self.any = hashlib.sha256(), False

    def _put(self, role: str, text: str) -> None:
        self.digest.update((("\n" if self.any else "") + role + ":" + text).encode())
        self.any = True

    def _insertions(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._forced("")
            self.at += 1

    def _forced(self, text: str) -> None:
        self.state = FORCED[self.state]
        self._put("user" if self.state == 2 else "assistant", text)

    def row(self, role: str, text: str) -> None:
        self._insertions()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "R":
            self._forced(text)
        elif letter == "K":
            self.state = KEPT[self.state][_KINDS.get(role[:1], OTHER)]
            self._put(role, text)

    def end(self) -> str:
        self._insertions()
        return self.digest.hexdigest()


_KINDS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}


def damaged(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, copy)`` of ``(conv_id, turn, role, text)`` with faults put in by a hash of the place.

    A null is one space in the hash, as role and as text. Of twenty rows one is dropped
    (kept here with a null ``copy``, so that its conversation stays known), emptied, loses
    its sentence marks, is repeated (``copy`` 1) or speaks as user.
    """
    as_text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(as_text("conv_id"), F.lit(":"), as_text("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(as_text("text"), "[.!?]", "")).otherwise(as_text("text"))
    role = F.when(kind == 4, "user").otherwise(as_text("role"))
    none, one = F.lit(None).cast("int"), F.lit(0)
    copies = F.when(kind == 0, F.array(none)).when(kind == 3, F.array(one, F.lit(1))).otherwise(F.array(one))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy"))


def _trimmed(text: Column) -> Column:
    return F.rtrim(text, F.lit(WHITE))


def _marked(rows: DataFrame) -> DataFrame:
    """``rows (conv_id, turn, role, text, copy)`` without texts: ``(conv_id, turn, role, digest, copy, code)``.

    A row is a duplicate if its role and text stand before it. The first of each is found by an
    aggregate, which copies reach in one row per task, and joined back.
    """
    last = F.substring(_trimmed(F.col("text")), -1, 1)
    fault = F.when(last == "", BLANK).when(last.isin(".", "!", "?"), SOUND).otherwise(CUT_OFF)
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)
    light = rows.select(
        "conv_id", "turn", "role", _digest().alias("digest"), "copy",
        F.when(F.col("copy").isNotNull(), fault).alias("fault"), kind.alias("kind"))
    # nulls first: a null turn stands before all others
    place = F.struct(F.col("turn").isNotNull().alias("some"), F.col("turn").alias("turn"), F.col("copy").alias("copy"))
    there = light.where("copy is not null")
    firsts = there.groupBy("conv_id", "role", "digest").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    firsts = firsts.where("n > 1").select(
        F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    joined = light.join(firsts, same, "left")
    later = F.col("first").isNotNull() & (place != F.col("first"))
    # equal rows of one turn share a place; all but one of them are duplicates too
    code = F.col("kind") + 4 * F.when(F.col("fault") == BLANK, BLANK).when(later, DUPLICATE).otherwise(F.col("fault"))
    return joined.select("conv_id", "turn", "role", "digest", "copy", F.col("first").isNotNull().alias("twin"), code.alias("code"))


def _digest() -> Column:
    return F.unhex(F.md5(F.col("text").cast("binary")))


#: Order of a conversation's rows; the last three only settle equal turns.
ORDER = ("turn", "role", "digest", "copy")


def _audits(marked: DataFrame) -> DataFrame:
    """Counts, cost and audit of every conversation of ``marked``; a byte per row is held at a time."""
    kind = marked.schema["conv_id"].dataType.simpleString()
    turn_kind = marked.schema["turn"].dataType.simpleString()
    if turn_kind not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"turns are integers, not {turn_kind}")
    parts = max(1, int(marked.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = marked.repartition(parts, "conv_id").sortWithinPartitions("conv_id", *ORDER)
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, turns, last, before = bytearray(), [None, None, 0], None, None  # turns: least, largest, distinct

        def done() -> list:
            faults = [sum(codes.count(f * 4 + k) for k in range(4)) for f in (BLANK, DUPLICATE, CUT_OFF)]
            kinds = bytes(c & 3 for c in codes)
            legal = sum(1 for p in zip(kinds, kinds[1:]) if p in ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)))
            cost, audit = cheapest(bytes(codes))
            gaps = turns[1] - turns[0] + 1 - turns[2] if turns[2] else 0
            return [last[0], gaps, *faults, max(0, len(codes) - 1 - legal), cost, audit]

        for batch in batches:
            out = []
            for conv, turn, role, digest, copy, twin, code in zip(*(c.to_pylist() for c in batch.columns)):
                if last is None or conv != last[0]:
                    if last is not None:
                        out.append(done())
                    codes, turns, last, before = bytearray(), [None, None, 0], (conv,), None
                if copy is None:
                    continue
                if turn is not None and (not turns[2] or turn != turns[1]):
                    turns = [turns[0] if turns[2] else turn, turn, turns[2] + 1]
                here = (turn, role, digest, copy) if twin else None
                if twin and here == before and code >> 2 != BLANK:
                    code = code & 3 | DUPLICATE << 2
                before = here
                codes.append(code)
            yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in out], schema=arrow)
        if last is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(names, done()))], schema=arrow)

    schema = f"conv_id {kind}, " + ", ".join(f"{n} bigint" for n in names[1:-1]) + ", audit string"
    arrow = pa.schema([pa.field("conv_id", _arrow_type(marked, "conv_id")), *((n, pa.int64()) for n in names[1:-1]), ("audit", pa.string())])
    return ordered.mapInArrow(run, schema)


def _arrow_type(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", damage: bool = False, keep_rows: bool = False) -> DataFrame:
    """One row per conversation: ``gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    A row's faults: ``blank`` (white space only), ``duplicate`` (role and text stand before it) and
    ``truncated`` (the last character that is not white space ends no sentence); the first
    counts. ``gaps``: turns missing between the least and the largest; ``illegal``: neighbours whose
    initials are not ``su``, ``ua`` or ``au``. Blank rows and duplicates are deleted. With ``damage``
    faults are put in first (``damaged``). With ``keep_rows`` the result is the repaired rows themselves,
    ``(conv, place, role, text)``, instead.

    Rows stand by turn, nulls first, then by role and MD5 of the text, so equal rows of one turn
    are neighbours. Null roles and texts are one space; a null conversation id is a
    conversation of its own; one without rows (all dropped) has zeros, an empty audit and the
    digest of nothing. An empty table gives no rows; other columns are not looked at.

    Texts pass through a task as a stream and only one byte per row is held, so a
    conversation of any length needs no more memory than its audit.
    """
    named = rows.select(*(F.col(c).alias(n) for c, n in ((conv_col, "conv_id"), (turn_col, "turn"), (role_col, "role"), (text_col, "text"))))
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    if damage:
        named = damaged(named)
    else:
        named = named.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), F.lit(0).alias("copy"))
    audits = materialize(_audits(_marked(named)), "audits")
    counts = audits.columns[1:]
    kind = rows.schema[conv_col].dataType.simpleString()
    heads = audits.select("conv_id", F.lit(0).alias("row"), *counts)
    texts = named.where("copy is not null").select(
        "conv_id", F.lit(1).alias("row"), "turn", "role", _digest().alias("digest"), "copy", "text")
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    both = heads.unionByName(texts, allowMissingColumns=True).repartition(parts, "conv_id")
    both = both.sortWithinPartitions("conv_id", "row", *ORDER).select("conv_id", "row", *counts, "role", "text")
    types = {**{c: pa.int64() for c in counts[:-1]}, "audit": pa.string()}
    own = _arrow_type(audits, "conv_id")
    if keep_rows:
        return both.mapInArrow(_rows_of(own), f"conv_id {kind}, place bigint, role string, text string").withColumnRenamed("conv_id", conv_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, state = None, None
        arrow = pa.schema([("conv_id", own), *types.items(), ("repaired_sha256", pa.string())])
        for batch in batches:
            out = []
            columns = [c.to_pylist() for c in batch.columns]
            for conv, row, *values in zip(*columns):
                if row == 0:
                    if head is not None:
                        out.append({**head, "repaired_sha256": state.end()})
                    head, state = {"conv_id": conv, **dict(zip(counts, values))}, Repaired(values[len(counts) - 1])
                else:
                    state.row(values[-2], values[-1])
            yield pa.RecordBatch.from_pylist(out, schema=arrow)
        if head is not None:
            yield pa.RecordBatch.from_pylist([{**head, "repaired_sha256": state.end()}], schema=arrow)

    schema = f"conv_id {kind}, " + ", ".join(f"{c} bigint" for c in counts[:-1]) + ", audit string, repaired_sha256 string"
    return both.mapInArrow(run, schema).withColumnRenamed("conv_id", conv_col)


def _rows_of(own: pa.DataType):
    """The repaired rows of a stream of audits, each before the rows of its conversation."""

    class Rows(Repaired):
        def __init__(self, conv, audit: str):
            super().__init__(audit)
            self.conv, self.rows, self.place = conv, [], 0

        def _put(self, role: str, text: str) -> None:
            self.rows.append({"conv_id": self.conv, "place": self.place, "role": role, "text": text})
            self.place += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = pa.schema([("conv_id", own), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])
        state = None
        for batch in batches:
            out = []
            audits = batch.column(batch.schema.get_field_index("audit")).to_pylist()
            for conv, row, audit, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 1)), audits, *(c.to_pylist() for c in batch.columns[-2:])):
                if row == 0:
                    if state is not None:
                        state.end()
                        out += state.rows
                    state = Rows(conv, audit)
                else:
                    state.row(role, text)
            if state is not None:
                out += state.rows
                state.rows = []
            yield pa.RecordBatch.from_pylist(out, schema=arrow)
        if state is not None:
            state.end()
            yield pa.RecordBatch.from_pylist(state.rows, schema=arrow)

    return run
