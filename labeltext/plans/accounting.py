"""The corpus job with its own row accounting: counts are observed while it runs."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from labeltext.constants import MAX_WORDS, MIN_WORDS, STOP_WORDS, TYPE_CODES
from labeltext.functions import text as tx
from labeltext.plans.corpus import funnel
from labeltext.sources import write_corpus
from labeltext.timing import Timings

#: The steps in order, as :func:`labeltext.plans.funnel` names them.
STEPS = ("label", "mentions", "blank", "raw duplicates", "word range", "clean duplicates")


def _observed(observation: Observation) -> dict[str, int]:
    """What was counted; nothing where the optimizer left the step out, as it does if no row comes out at the end."""
    try:
        return observation.get
    except Py4JJavaError as e:
        if "toPyRow" not in str(e):  # a row without columns cannot be converted
            raise
        return {}


def write_accounted(
    posts: DataFrame,
    path: str,
    fmt: str = "parquet",
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
) -> DataFrame:
    """Write the corpus of :func:`prepare_corpus` to ``path``; rows per step and wall time of the job.

    ``(step_no, step, rows_before, rows_after, removed, seconds)``, one row a step;
    ``seconds`` is the wall time of the whole job, whose steps run at the same
    time. There is no second scan: the filters' counts are observed in the stage
    that reads, the others behind the aggregates. To count raw duplicates the job
    groups by raw and cleaned text before it groups by cleaned text, which costs
    one exchange more than :func:`prepare_corpus`. Where no row is left at the end,
    Spark drops steps together with what they observed, and ``funnel`` counts instead. Tasks of a stage that run
    again after a lost executor are observed again, so counts can then be too high;
    the corpus is not touched by that, and ``funnel`` counts exactly.
    """
    names = F.array(*[F.lit(code) for code in vocab])
    code = F.array_position(names, tx.label_of(F.col(flair), vocab))
    leak = vocab if mention_vocab is None else mention_vocab
    reached = (
        F.when(F.coalesce(code, F.lit(0)) == 0, 0)
        .when(tx.mentions(F.col(body), leak), 1)
        .when(tx.is_blank(F.col(body)), 2)
        .otherwise(3)
    )
    filters, groups, written = Observation(), Observation(), Observation()
    rows = posts.select(id_col, code.alias("_code"), F.col(body), F.explode(F.array(reached)).alias("_reached"))
    rows = rows.observe(
        filters, F.count(F.lit(1)).alias("r0"), *(F.count_if(F.col("_reached") >= i).alias(f"r{i}") for i in (1, 2, 3)))
    cleaned = rows.where("_reached = 3").select(
        F.col(id_col).alias("_id"), "_code", F.unhex(F.sha2(tx.as_text(F.col(body)), 256)).alias("_raw"),
        F.explode(F.array(tx.clean_tokens(F.col(body), variant, stop_words))).alias("_words"))
    in_range = F.when(F.size("_words").between(lo, hi), F.array_join("_words", " "))
    first = [F.min_by("_code", "_id").alias("_code"), F.min("_id").alias("_id")]
    raw = cleaned.select("_id", "_code", "_raw", in_range.alias("_text")).groupBy("_text", "_raw").agg(*first)
    raw = raw.observe(groups, F.count(F.lit(1)).alias("r4"), F.count("_text").alias("r5"))
    corpus = raw.where("_text is not null").groupBy("_text").agg(*first).select(
        F.element_at(names, F.col("_code").cast("int")).alias(label), F.col("_text").alias(text))
    # behind the sort, which reads its input twice
    corpus = corpus.orderBy(text) if ordered else corpus
    timings = Timings()
    with timings.timed("write"):
        write_corpus(corpus.observe(written, F.count(F.lit(1)).alias("r6")), path, fmt)
    counts = {**_observed(filters), **_observed(groups), **_observed(written)}
    if len(counts) <= len(STEPS):  # an empty corpus: the steps before it are counted on their own
        exact = funnel(posts, variant, vocab, mention_vocab, id_col, flair, body, stop_words, lo, hi)
        return exact.withColumn("seconds", F.lit(timings["write"]))
    after = [int(counts[f"r{i}"]) for i in range(len(STEPS) + 1)]
    return posts.sparkSession.createDataFrame(
        [(i + 1, step, after[i], after[i + 1], after[i] - after[i + 1], timings["write"]) for i, step in enumerate(STEPS)],
        "step_no int, step string, rows_before bigint, rows_after bigint, removed bigint, seconds double")
