"""Word-index sequences of fixed length."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labeltext.constants import OOV_INDEX, SEQUENCE_LENGTH, SEQUENCE_WORDS
from labeltext.functions import arrays as ar
from labeltext.functions import text as tx
from labeltext.operators.features import split_train_val
from labeltext.session import materialize

_POSITIONS = 1 << 31

#: Words that may be looked up inside the row.
MOST_ROW_WORDS = 200_000


def fit_sequence_vocab(
    df: DataFrame,
    id_col: str = "doc_id",
    text: str = "posts",
    num_words: int = SEQUENCE_WORDS,
) -> DataFrame:
    """Word indices by frequency, ``(word, idx)``.

    Index 0 is padding and 1 the unknown word, so the most frequent word gets 2
    and only indices below ``num_words`` exist. Equal counts are ordered by first
    appearance (smallest id, then position). That key is packed in one decimal:
    a fixed-width value keeps the aggregate over all tokens hash-based, which a
    struct would turn into a sort.
    """
    first = F.col(id_col).cast("decimal(20,0)") * F.lit(_POSITIONS) + F.col("pos")
    ranked = (
        df.select(id_col, F.posexplode(tx.tokenize_keras(F.col(text))).alias("pos", "word"))
        .groupBy("word")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(first.cast("decimal(31,0)")).alias("first"),
        )
        .orderBy(F.desc("n"), "first")
        .limit(num_words - 2)
    )
    # At most num_words rows are left, so one task can number them.
    order = Window.orderBy(F.desc("n"), "first")
    return ranked.select("word", (F.row_number().over(order) + OOV_INDEX).alias("idx"))


def _lookup_table(vocab: DataFrame, buckets: int):
    """The vocabulary as one array of hash buckets, for constant-time lookup."""
    bucket = F.pmod(F.xxhash64("word"), F.lit(buckets))
    filled = vocab.groupBy(bucket.alias("b")).agg(
        F.collect_list(F.struct("word", "idx")).alias("words")
    )
    slots = vocab.sparkSession.range(buckets).withColumnRenamed("id", "b")
    table = slots.join(filled, "b", "left").agg(
        F.array_sort(F.collect_list(F.struct("b", "words"))).alias("slots")
    )
    return table.select(F.transform("slots", lambda s: s["words"])).scalar()


def _encode_in_row(df: DataFrame, vocab: DataFrame, tokens: str, out: str, num_words: int):
    if num_words > MOST_ROW_WORDS:
        raise ValueError(f"more than {MOST_ROW_WORDS} words do not fit a row; use method='join'")
    buckets = 1 << max(num_words - 1, 1).bit_length()
    table = df.withColumn("_table", _lookup_table(vocab, buckets))

    def index_of(word):
        slot = F.get(F.col("_table"), F.pmod(F.xxhash64(word), F.lit(buckets)).cast("int"))
        hit = F.get(F.filter(slot, lambda e: e["word"] == word), F.lit(0))
        return F.coalesce(hit["idx"], F.lit(OOV_INDEX))

    return table.withColumn(out, F.transform(tokens, index_of)).drop("_table")


def _encode_by_join(df: DataFrame, vocab: DataFrame, tokens: str, out: str):
    """As :func:`_encode_in_row`, through a join; rows are told apart by a number of their own.

    The numbered rows are written first, so a repeated task cannot number them anew.
    """
    rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "rows")
    words = rows.select("_row", F.posexplode(tokens).alias("pos", "word"))
    coded = (
        words.join(vocab, "word", "left")
        .groupBy("_row")
        .agg(F.collect_list(F.struct("pos", F.coalesce("idx", F.lit(OOV_INDEX)).alias("i"))).alias("p"))
        .select("_row", F.transform(F.array_sort("p"), lambda e: e["i"]).alias(out))
    )
    empty = F.when(F.col(tokens).isNotNull(), F.array().cast("array<int>"))
    coded = rows.join(coded, "_row", "left").withColumn(out, F.coalesce(F.col(out), empty))
    return coded.drop("_row")


def encode_sequences(
    df: DataFrame,
    vocab: DataFrame,
    text: str = "posts",
    out: str = "seq",
    num_words: int = SEQUENCE_WORDS,
    maxlen: int | None = None,
    pad: bool = False,
    method: str = "row",
) -> DataFrame:
    """Texts as arrays of word indices; unknown words become 1, a null text stays null.

    ``maxlen`` keeps the last words of a text. A word maps to exactly one index,
    so the cut is made before the lookup. With ``method="row"`` the vocabulary, at
    most ``num_words`` rows, becomes a scalar of hash buckets probed inside the
    row, without explode, join or shuffle. ``method="join"`` is for vocabularies
    that do not fit a task; the result is the same.
    """
    if method not in ("row", "join"):
        raise ValueError(f"method must be 'row' or 'join', not {method!r}")
    words = tx.tokenize_keras(F.col(text))
    if maxlen is not None:
        words = ar.keep_last(words, maxlen)
    split = df.select(*df.columns, F.explode(F.array(words)).alias("_words"))
    if method == "row":
        coded = _encode_in_row(split, vocab, "_words", out, num_words)
    else:
        coded = _encode_by_join(split, vocab, "_words", out)
    coded = coded.drop("_words")
    if pad:
        coded = coded.withColumn(out, ar.pad_sequence(F.col(out), maxlen or SEQUENCE_LENGTH))
    return coded


def pad_sequences(df: DataFrame, col: str = "seq", maxlen: int = SEQUENCE_LENGTH) -> DataFrame:
    """Fixed-length sequences: front cut off, zeros at the end."""
    return df.withColumn(col, ar.pad_sequence(F.col(col), maxlen))


def encoding_summary(
    df: DataFrame,
    id_col: str = "doc_id",
    text: str = "posts",
    maxlen: int = SEQUENCE_LENGTH,
) -> DataFrame:
    """One row: training rows, validation rows, vocabulary size, sequence length.

    The vocabulary counts every word seen plus the unknown word.
    """
    words = (
        df.select(F.explode(F.array_distinct(tx.tokenize_keras(F.col(text)))).alias("word"))
        .distinct()
        .agg(F.count(F.lit(1)) + 1)
        .scalar()
    )
    return split_train_val(df.select(id_col), id_col).agg(
        F.count_if(~F.col("is_val")).alias("train_rows"),
        F.count_if(F.col("is_val")).alias("val_rows"),
    ).select("train_rows", "val_rows", words.alias("vocab_size"), F.lit(maxlen).alias("max_length"))
