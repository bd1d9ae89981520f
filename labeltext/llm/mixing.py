"""Mixing sources to target weights by Pfair scheduling, in DataFrame operations only.

Rows of a source form blocks. Time runs in frames: in each frame a source gets as
many blocks as its weight has parts, or what is left of it. Within a frame block
``j`` of ``c``, out of ``C`` blocks in all, is released at ``floor(j C / c)`` and due
at ``ceil((j + 1) C / c)``; of the released blocks the one due earliest goes next.
All deadlines can be met, so no source is ever a whole block ahead of or behind
its share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labeltext.llm.names import free_name, quoted
from labeltext.session import materialize

#: Rows of one source are numbered in so many groups, by a digest of the row.
GROUPS = 4096

#: Shapes of frames (two per source at most) times parts: bounds the plan of slots.
MOST_SLOTS = 1_000_000


def edf(counts: Column) -> Column:
    """The source (its place in ``counts``) of every slot of a frame.

    Earliest deadline first among released blocks; ties go to the earlier source.
    """
    total = F.aggregate(counts, F.lit(0), lambda a, x: a + x)

    def frame(c: Column, n: Column) -> Column:
        start = F.struct(F.transform(c, lambda x: F.lit(0)).alias("next"), F.array().cast("array<int>").alias("slots"))

        def slot(state: Column, t: Column) -> Column:
            ready = F.filter(F.transform(c, lambda x, i: F.when(
                (F.get(state["next"], i) < x) & (F.floor(F.get(state["next"], i) * n / x) <= t),
                F.struct(F.ceil((F.get(state["next"], i) + 1) * n / x).alias("due"), i.alias("i")),
            )), lambda x: x.isNotNull())
            pick = F.array_min(ready)["i"]
            return F.transform(F.array(pick), lambda p: F.struct(
                F.transform(state["next"], lambda x, i: F.when(i == p, x + 1).otherwise(x)).alias("next"),
                F.concat(state["slots"], F.array(p)).alias("slots")))[0]

        return F.aggregate(F.sequence(F.lit(0), n - 1), start, slot, lambda s: s["slots"])

    return F.transform(F.array(F.struct(counts.alias("c"), total.alias("n"))), lambda s: F.when(
        s["n"] > 0, frame(s["c"], s["n"])).otherwise(F.array().cast("array<int>")))[0]


def schedule(sizes: DataFrame, parts: dict[str, int]) -> DataFrame:
    """``(source, first_frame, last_frame, base, total, j, slot, release, due)``: slots by shape of frame.

    ``sizes``: ``(source, blocks)``. A shape holds for the frames ``first_frame`` to
    ``last_frame``; frame ``f`` begins at slot ``base + (f - first_frame) * total``.
    ``j`` counts the source's blocks within a frame, ``slot`` the slots from its
    beginning. The sources are those of ``parts``, so all this is small.
    """
    names = sorted(parts)
    given = sizes.groupBy().agg(F.map_from_entries(F.collect_list(F.struct("source", "blocks"))).alias("m"))
    blocks = F.array(*(F.coalesce(F.col("m")[F.lit(n)], F.lit(0)).cast("bigint") for n in names))
    share = F.array(*(F.lit(parts[n]).cast("bigint") for n in names))
    frames = given.select(blocks.alias("n"), share.alias("q"))
    # shapes change where a source has its last whole frame and after its last one
    edges = F.array_sort(F.array_distinct(F.concat(
        F.array(F.lit(0).cast("bigint")),
        F.transform("n", lambda n, i: F.floor(n / F.get(F.col("q"), i)).cast("bigint")),
        F.transform("n", lambda n, i: F.ceil(n / F.get(F.col("q"), i)).cast("bigint")),
    )))
    frames = frames.select("n", "q", edges.alias("e"))
    frames = frames.select("n", "q", "e", F.posexplode("e").alias("at", "first_frame"))
    frames = frames.where(F.col("at") < F.size("e") - 1).withColumn("last_frame", F.get("e", F.col("at") + 1) - 1)
    f = F.col("first_frame")
    counts = F.transform("n", lambda n, i: F.least(F.get(F.col("q"), i), F.greatest(n - f * F.get(F.col("q"), i), F.lit(0))).cast("int"))
    base = F.aggregate(F.transform("n", lambda n, i: F.least(n, f * F.get(F.col("q"), i))), F.lit(0).cast("bigint"), lambda a, x: a + x)
    shapes = frames.select("first_frame", "last_frame", base.alias("base"), F.explode(F.array(counts)).alias("counts"))
    shapes = shapes.withColumn("total", F.aggregate("counts", F.lit(0), lambda a, x: a + x))
    slots = shapes.select("*", F.posexplode(edf(F.col("counts"))).alias("slot", "who"))
    j = F.row_number().over(Window.partitionBy("first_frame", "who").orderBy("slot")) - 1
    slots = slots.withColumn("j", j).withColumn("c", F.get("counts", F.col("who")))
    return slots.select(
        F.element_at(F.array(*map(F.lit, names)), F.col("who") + 1).alias("source"), "first_frame", "last_frame", "base",
        "total", "j", "slot", F.floor(F.col("j") * F.col("total") / F.col("c")).alias("release"),
        F.ceil((F.col("j") + 1) * F.col("total") / F.col("c")).alias("due"),
    )


def result_names(columns: list[str]) -> dict[str, str]:
    """Names of the new columns of ``interleave`` beside ``columns``: a taken one gets more underscores in front."""
    return {n: free_name("_" + n, columns) for n in ("block", "release", "due", "slot", "offset")}


def interleave(docs: DataFrame, parts: dict[str, int], rest_parts: int = 1, block_rows: int = 16,
               id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """Every row of ``docs`` with its place in the mix.

    New columns: ``_block`` (of its source, from 0), ``_release`` and ``_due`` (slots
    between which the block has to go), ``_slot`` and ``_offset`` (row within the
    block); see ``result_names`` for columns of ``docs`` that have such a name. ``parts`` gives each source's weight in whole parts; all other sources,
    null among them, share ``rest_parts`` as one. No row is dropped or repeated: a
    source that runs out leaves its share to the others. Within a source rows come
    in the order of a digest of the id, then of the row; empty input stays empty.

    Rows are numbered within groups of a source, whose sizes are summed apart, so a
    source that holds most rows is spread over GROUPS tasks; the plan of slots is
    joined by source and place in the frame.
    """
    rest = "\0rest"
    weights = {**parts, rest: rest_parts}
    if min(weights.values()) < 1 or 2 * len(weights) * sum(weights.values()) > MOST_SLOTS:
        raise ValueError(f"parts have to be positive; twice their sum times sources {MOST_SLOTS} at most")
    source = F.coalesce(F.when(quoted(source_col).isin(list(parts)), quoted(source_col)), F.lit(rest))
    others = [c for c, t in docs.dtypes if c != id_col and not t.startswith("map")]
    as_json = F.to_json(F.struct(*map(quoted, others))) if others else F.lit("")
    digest = F.md5(F.coalesce(quoted(id_col).cast("string"), as_json))
    # the caller's columns travel in one, so that no name of theirs meets one of these
    rows = docs.select(F.struct(*map(quoted, docs.columns)).alias("row"), source.alias("_source"), digest.alias("_digest"))
    cell = lambda c: F.col("row").getField(c)
    rows = rows.withColumn("_group", F.conv(F.substring("_digest", 1, 8), 16, 10).cast("bigint") % GROUPS)
    groups = materialize(rows.groupBy("_source", "_group").agg(F.count("*").alias("_n")), "groups")
    before = Window.partitionBy("_source").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    starts = groups.select("_source", "_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    sizes = groups.groupBy("_source").agg(F.ceil(F.sum("_n") / block_rows).alias("blocks")).withColumnRenamed("_source", "source")
    slots = schedule(sizes, weights)

    within = Window.partitionBy("_source", "_group").orderBy("_digest", *map(cell, [id_col, *others]))
    rows = rows.withColumn("_at", F.row_number().over(within) - 1).join(starts, ["_source", "_group"])
    rows = rows.withColumn("_at", F.col("_at") + F.col("_start"))
    rows = rows.withColumn("_block", F.floor(F.col("_at") / block_rows)).withColumn("_offset", (F.col("_at") % block_rows).cast("int"))
    share = F.create_map(*(x for s, q in weights.items() for x in (F.lit(s), F.lit(q))))[F.col("_source")]
    rows = rows.withColumn("_frame", F.floor(F.col("_block") / share)).withColumn("_j", F.col("_block") % share)
    rows = rows.join(F.broadcast(slots), (  # MOST_SLOTS rows at most
        (rows["_source"] == slots["source"]) & (rows["_j"] == slots["j"])
        & rows["_frame"].between(slots["first_frame"], slots["last_frame"])))
    begin = F.col("base") + (F.col("_frame") - F.col("first_frame")) * F.col("total")
    new = result_names(docs.columns)
    return rows.select(
        *(cell(c).alias(c) for c in docs.columns), F.col("_block").cast("bigint").alias(new["block"]),
        (begin + F.col("release")).alias(new["release"]), (begin + F.col("due")).alias(new["due"]),
        (begin + F.col("slot")).alias(new["slot"]), F.col("_offset").alias(new["offset"]),
    )
