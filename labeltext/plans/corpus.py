"""Whole jobs over raw posts: the cleaned corpus and its row accounting."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labeltext.constants import MAX_WORDS, MIN_WORDS, STOP_WORDS, TYPE_CODES
from labeltext.functions import text as tx


def prepare_corpus(
    posts: DataFrame,
    variant: str = "parallel",
    vocab: Sequence[str] = TYPE_CODES,
    mention_vocab: Sequence[str] | None = None,
    id_col: str = "row_id",
    flair: str = "author_flair_text",
    body: str = "body",
    label: str = "type",
    text: str = "posts",
    stop_words: Iterable[str] = STOP_WORDS,
    lo: int = MIN_WORDS,
    hi: int = MAX_WORDS,
    ordered: bool = True,
    keep_id: bool = False,
) -> DataFrame:
    """Raw posts to the labelled, cleaned, duplicate-free corpus ``(label, text)``.

    Order of the steps: label from the flair, drop rows without one, drop texts
    that name a code, drop blank texts, first row per raw text, clean, keep
    ``lo`` to ``hi`` words, first row per cleaned text, sort by text.

    Equal raw texts clean to equal texts, and "first" is the smallest id both
    times, so the first row per cleaned text is the same with or without the
    raw step. One aggregate therefore does both removals, and one shuffle of
    text is saved. The label travels as its position in ``vocab``: with two
    fixed-width values the aggregate is hash-based and copies collapse before
    the shuffle.

    The one-element ``explode`` evaluates the cleaning once; otherwise the
    optimizer would repeat it in the word-count filter and in the projection.

    With ``keep_id`` the id of the kept row comes first, so that a split or a model
    job can follow.
    """
    names = F.array(*[F.lit(code) for code in vocab])
    code = F.array_position(names, tx.label_of(F.col(flair), vocab))
    leak = vocab if mention_vocab is None else mention_vocab
    cleaned = (
        posts.select(id_col, code.alias("code"), body)
        .filter(F.col("code") > 0)
        .filter(~tx.mentions(F.col(body), leak))
        .filter(~tx.is_blank(F.col(body)))
        .select(
            id_col, "code",
            F.explode(F.array(tx.clean_tokens(F.col(body), variant, stop_words))).alias("words"),
        )
        .filter(F.size("words").between(lo, hi))
        .select(id_col, "code", F.array_join("words", " ").alias(text))
    )
    first = cleaned.groupBy(text).agg(
        F.min_by("code", id_col).alias("code"), *[F.min(id_col).alias(id_col)] * keep_id
    )
    corpus = first.select(
        *[id_col] * keep_id, F.element_at(names, F.col("code").cast("int")).alias(label), text
    )
    return corpus.orderBy(text) if ordered else corpus


def funnel(
    posts: DataFrame,
    variant: str = "parallel",
    vocab: Sequence[str] = TYPE_CODES,
    mention_vocab: Sequence[str] | None = None,
    id_col: str = "row_id",
    flair: str = "author_flair_text",
    body: str = "body",
    stop_words: Iterable[str] = STOP_WORDS,
    lo: int = MIN_WORDS,
    hi: int = MAX_WORDS,
) -> DataFrame:
    """Rows before, after and removed for every step of :func:`prepare_corpus`.

    One scan. Texts are replaced by their 256-bit digest inside the task, and
    rows are first grouped by that digest, so neither texts nor repeated copies
    are shuffled.
    """
    leak = vocab if mention_vocab is None else mention_vocab
    reached = (
        F.when(tx.label_of(F.col(flair), vocab).isNull(), 0)
        .when(tx.mentions(F.col(body), leak), 1)
        .when(tx.is_blank(F.col(body)), 2)
        .otherwise(3)
    )
    tokens = tx.clean_tokens(F.col(body), variant, stop_words)
    digests = (
        posts.select(tx.as_text(F.col(body)).alias(body), F.explode(F.array(reached)).alias("reached"))
        .select(body, "reached", F.explode(F.array(F.when(F.col("reached") == 3, tokens))).alias("words"))
        .select(
            "reached",
            F.when(F.col("reached") == 3, F.unhex(F.sha2(body, 256))).alias("raw"),
            F.when(
                F.size("words").between(lo, hi),
                F.unhex(F.sha2(F.array_join("words", " "), 256)),
            ).alias("clean"),
        )
        .groupBy("reached", "raw", "clean")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # One row per raw text that passed the filters: those groups are the rows left
    # by the first duplicate removal, their distinct clean digests by the second.
    totals = digests.agg(
        F.sum("n").alias("r0"),
        F.sum(F.when(F.col("reached") >= 1, F.col("n"))).alias("r1"),
        F.sum(F.when(F.col("reached") >= 2, F.col("n"))).alias("r2"),
        F.sum(F.when(F.col("reached") >= 3, F.col("n"))).alias("r3"),
        F.count("raw").alias("r4"),
        F.count("clean").alias("r5"),
        F.count_distinct("clean").alias("r6"),
    ).select(*[F.coalesce(f"r{i}", F.lit(0).cast("long")).alias(f"r{i}") for i in range(7)])
    names = ["label", "mentions", "blank", "raw duplicates", "word range", "clean duplicates"]
    steps = [
        F.struct(
            F.lit(i + 1).alias("step_no"),
            F.lit(name).alias("step"),
            F.col(f"r{i}").alias("rows_before"),
            F.col(f"r{i + 1}").alias("rows_after"),
            (F.col(f"r{i}") - F.col(f"r{i + 1}")).alias("removed"),
        )
        for i, name in enumerate(names)
    ]
    return totals.select(F.inline(F.array(*steps)))
