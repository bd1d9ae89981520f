"""Corpus statistics.

All of them start with an aggregate whose map side already reduces the data to
(group, term) or class size, so hot classes and hot words are absorbed before
any shuffle. Windows and arrays are only used on class- or vocabulary-sized
results.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labeltext.constants import (
    LETTER_AXES,
    STATS_VOCABULARY,
    STOP_WORDS,
    TOP_MI_K,
    TOP_TFIDF_K,
    TOP_WORDS_K,
)
from labeltext.functions import text as tx
from labeltext.operators.features import document_terms
from labeltext.operators.topk import top_k, top_k_per_group


def class_distribution(df: DataFrame, col: str = "type") -> DataFrame:
    """Rows and percent per class; rows without a class are left out.

    The total is a scalar subquery over the class counts, which reuses their
    exchange; no unpartitioned window is involved.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("pct", F.lit(100.0) * F.col("n") / total).orderBy(F.desc("n"), col)


def axis_marginals(df: DataFrame, col: str = "type", axes=LETTER_AXES) -> DataFrame:
    """Counts of both letters on every axis and their percent within the axis.

    Codes are counted first; the axes are unfolded on that class-sized table.
    Letters that never occur keep a row with zero.
    """
    classes = df.groupBy(col).agg(F.count(F.lit(1)).alias("n_class"))
    cells = [
        F.struct(
            F.lit(axis).alias("axis"),
            F.lit(letter).alias("letter"),
            F.when(F.substring(col, pos, 1) == letter, F.col("n_class"))
            .otherwise(F.lit(0).cast("long"))
            .alias("hits"),
        )
        for axis, pos, letters in axes
        for letter in letters
    ]
    counts = (
        classes.select(F.inline(F.array(*cells)))
        .groupBy("axis", "letter")
        .agg(F.sum("hits").alias("n"))
    )
    within = F.sum("n").over(Window.partitionBy("axis"))
    return counts.withColumn("pct", F.lit(100.0) * F.col("n") / within)


def distinct_labels(df: DataFrame, col: str = "type") -> DataFrame:
    """The classes that occur."""
    return df.select(col).distinct()


def explode_terms(
    df: DataFrame, text: str, keep: Iterable[str] = (), stop_words: Iterable[str] = ()
) -> DataFrame:
    """One row per token, with the ``keep`` columns; stop words go before the explode."""
    tokens = tx.remove_stop_words(tx.tokenize_words(F.col(text)), stop_words)
    return df.select(*keep, F.explode(tokens).alias("term"))


def term_counts(
    df: DataFrame, group: str, text: str, stop_words: Iterable[str] = ()
) -> DataFrame:
    """Occurrences of every term per group (a class or a document)."""
    return (
        explode_terms(df, text, [group], stop_words)
        .groupBy(group, "term")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def top_words(
    df: DataFrame,
    label: str = "type",
    text: str = "posts",
    k: int = TOP_WORDS_K,
    stop_words: Iterable[str] = STOP_WORDS,
) -> DataFrame:
    """The ``k`` most frequent words of every class."""
    counts = term_counts(df, label, text, stop_words)
    return top_k_per_group(counts, label, [F.desc("n"), F.asc("term")], k)


def class_tfidf(
    df: DataFrame,
    label: str = "type",
    text: str = "posts",
    k: int = TOP_TFIDF_K,
    max_features: int = STATS_VOCABULARY,
    stop_words: Iterable[str] = STOP_WORDS,
) -> DataFrame:
    """Words that mark a class: TF-IDF with all texts of a class as one document.

    Term counts per class add up, so the class documents are never built. The
    weight is ``n * (ln((1 + classes) / (1 + df)) + 1)``, L2-normalised per class.
    A term carries its class counts along as an array (one entry per class), so
    the texts are read once and nothing is joined.
    """
    cells = F.collect_list(F.struct(label, "n"))
    terms = (
        term_counts(df, label, text, stop_words)
        .groupBy("term")
        .agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("df"), cells.alias("cells"))
    )
    vocab = top_k(terms, [F.desc("total"), F.asc("term")], max_features)
    n_classes = df.agg(F.count_distinct(label)).scalar()
    idf = F.log((F.lit(1.0) + n_classes) / (F.lit(1.0) + F.col("df"))) + 1.0
    weights = vocab.select("term", idf.alias("idf"), F.inline("cells")).select(
        label, "term", (F.col("n") * F.col("idf")).alias("w")
    )
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(label)))
    scored = weights.select(label, "term", F.round(F.col("w") / norm, 9).alias("score"))
    return top_k_per_group(scored, label, [F.desc("score"), F.asc("term")], k)


def _information(n_xy, n_x, n_y, total):
    """One cell of the mutual information sum; empty cells add nothing."""
    share = n_xy / total
    return F.when(n_xy > 0, share * F.log(n_xy * total / (n_x * n_y))).otherwise(0.0)


def mutual_information(
    df: DataFrame,
    label: str = "y",
    text: str = "posts",
    max_features: int = STATS_VOCABULARY,
    k: int | None = TOP_MI_K,
    stop_words: Iterable[str] = STOP_WORDS,
) -> DataFrame:
    """Mutual information (nats) of a term's count in a text with a 0/1 label.

    Counts per text are found inside its row, so all that leaves a task is how
    often (term, count) goes with either label. Those cells also give the total
    by which the ``max_features`` most frequent terms are chosen, and the cells
    of texts without the term follow by subtraction from the label totals: one
    pass over the texts, no join, nothing made dense.
    """
    labelled = df.filter(F.col(label).isNotNull())
    cells = (
        document_terms(labelled, [label], text, stop_words)
        .groupBy("term", "n")
        .agg(F.count_if(F.col(label) == 1).alias("n1"), F.count_if(F.col(label) == 0).alias("n0"))
    )
    totals = labelled.agg(
        F.count_if(F.col(label) == 1).alias("t1"), F.count_if(F.col(label) == 0).alias("t0")
    ).first()
    t1, t0 = F.lit(float(totals["t1"])), F.lit(float(totals["t0"]))
    n1, n0 = F.col("n1").cast("double"), F.col("n0").cast("double")
    per_term = cells.groupBy("term").agg(
        F.sum(F.col("n") * (F.col("n1") + F.col("n0"))).alias("total"),
        F.sum(
            _information(n1, n1 + n0, t1, t1 + t0) + _information(n0, n1 + n0, t0, t1 + t0)
        ).alias("present"),
        F.sum(n1).alias("s1"),
        F.sum(n0).alias("s0"),
    )
    vocab = top_k(per_term, [F.desc("total"), F.asc("term")], max_features)
    z1, z0 = t1 - F.col("s1"), t0 - F.col("s0")
    absent = _information(z1, z1 + z0, t1, t1 + t0) + _information(z0, z1 + z0, t0, t1 + t0)
    scored = vocab.select(
        "term", F.round(F.greatest(F.col("present") + absent, F.lit(0.0)), 9).alias("mi")
    )
    return scored if k is None else top_k(scored, [F.desc("mi"), F.asc("term")], k)


def concat_parts(
    df: DataFrame, group: str, col: str, order: str, sep: str = " ", out: str = "text",
    rows_per_part: int = 1000,
) -> DataFrame:
    """Texts of a group joined in order, in bounded pieces ``(group, part, text)``.

    ``order`` is an integer, unique within the group, so a part holds at most
    ``rows_per_part`` texts however large the group is. Parts in order give the
    whole text.
    """
    part = F.floor(F.col(order) / F.lit(rows_per_part)).alias("part")
    return df.groupBy(group, part).agg(_joined(col, order, sep).alias(out))


def _joined(col: str, order: str, sep: str):
    """The texts of a group in order, as one string."""
    texts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(col).alias("t"))))
    return F.array_join(F.transform(texts, lambda p: p["t"]), sep)


def concat_by_group(
    df: DataFrame, group: str, col: str, order: str, sep: str = " ", out: str = "text",
    rows_per_part: int = 1000,
) -> DataFrame:
    """Texts of a group joined in order into one string.

    The pieces of :func:`concat_parts` are joined, so a large group is sorted in
    many small parts. The one string per group is the result asked for; where it
    may not fit a row, use the pieces. Class statistics do without either.
    """
    parts = concat_parts(df, group, col, order, sep, "_t", rows_per_part)
    return parts.groupBy(group).agg(_joined("_t", "part", sep).alias(out))


def class_weights(df: DataFrame, label: str = "type") -> DataFrame:
    """Balanced weight ``n / (classes * n_class)`` per class; rows without one don't count."""
    counts = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(
        F.struct(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"))
    ).scalar()
    weight = totals["rows"].cast("double") / (totals["classes"] * F.col("n"))
    return counts.withColumn("weight", weight)
