"""Features: label indices, stable split, count and TF-IDF vectors, SVD."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import IDF, CountVectorizerModel, ElementwiseProduct, HashingTF, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labeltext.constants import MAX_CLASSES, SPLIT_SEED, STOP_WORDS, SVD_COMPONENTS, VALIDATION_SHARE
from labeltext.functions import text as tx
from labeltext.operators.topk import top_k
from labeltext.session import broadcast_bounded, materialize

#: Vocabularies and projection matrices pass through the driver and to every
#: executor, so their size is checked against these limits.
MAX_VOCABULARY_TERMS = 1 << 20
MAX_VOCABULARY_CHARS = 64 << 20
MAX_MATRIX_CELLS = 64 << 20
#: Extra directions and power passes of the randomised SVD.
SVD_OVERSAMPLE, SVD_PASSES = 10, 5
#: Terms whose document frequency is broadcast; see ``tfidf_table``.
HOT_TERMS = 10_000


# --- labels and split ---------------------------------------------------------

def label_array(df: DataFrame, label: str):
    """The classes in alphabetical order as a scalar array; more than MAX_CLASSES raise."""
    found = df.select(label).distinct().limit(MAX_CLASSES + 1).agg(F.array_sort(F.collect_list(label)).alias("c"))
    checked = F.when(F.size("c") <= MAX_CLASSES, F.col("c")).otherwise(
        F.raise_error(F.lit(f"more than {MAX_CLASSES} classes in {label!r}")))
    return found.select(checked).scalar()


def encode_labels(df: DataFrame, label: str = "type", out: str = "label") -> DataFrame:
    """Alphabetical index 0..k-1 of each label; a narrow lookup, no join."""
    position = F.array_position(label_array(df, label), F.col(label))
    return df.withColumn(out, (position - 1).cast("int"))


def decode_labels(
    df: DataFrame, classes: Sequence[str], col: str = "prediction", out: str = "predicted_type"
) -> DataFrame:
    """Inverse of :func:`encode_labels` for a known class list."""
    names = F.array(*[F.lit(c) for c in classes])
    return df.withColumn(out, F.get(names, F.col(col).cast("int")))


def split_train_val(
    df: DataFrame,
    id_col: str = "doc_id",
    frac: float = VALIDATION_SHARE,
    seed: int = SPLIT_SEED,
    out: str = "is_val",
) -> DataFrame:
    """Mark about ``frac`` of the rows for validation by a hash of their id.

    The same rows are chosen on every run, engine and partitioning, also when a
    lost task is run again; ``randomSplit`` gives no such promise.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    return df.withColumn(out, F.substring(digest, 1, 8) < F.lit(split_threshold(frac)))


def split_threshold(frac: float) -> str:
    """Eight hex digits below which a share ``frac`` of all hashes lies."""
    return format(min(int(frac * (1 << 32)), (1 << 32) - 1), "08x")


# --- vocabulary and count vectors ---------------------------------------------

def vocabulary_list(vocab: DataFrame, term: str = "term") -> list[str]:
    """The terms of a vocabulary table on the driver, checked, in alphabetical order."""
    rows = vocab.select(term).limit(MAX_VOCABULARY_TERMS + 1).collect()
    return sorted(_checked_terms([row[0] for row in rows]))


def _checked_terms(terms: list[str]) -> list[str]:
    if len(terms) > MAX_VOCABULARY_TERMS or sum(map(len, terms)) > MAX_VOCABULARY_CHARS:
        raise ValueError(
            f"the vocabulary has more than {MAX_VOCABULARY_TERMS} terms or "
            f"{MAX_VOCABULARY_CHARS} characters; set max_features, or use tfidf_vectors or tfidf_table"
        )
    return terms


def fit_idf(
    df: DataFrame, text: str, max_features: int | None, stop_words: Iterable[str] = ()
) -> tuple[list[str], list[float]]:
    """Vocabulary in alphabetical order and ``ln((1 + texts) / (1 + df)) + 1`` for it.

    One pass over the texts gives both the total count a term is ranked by and
    the number of texts it occurs in.
    """
    terms = (
        document_terms(df, [], text, stop_words)
        .groupBy("term")
        .agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("df"))
    )
    keep = MAX_VOCABULARY_TERMS + 1 if max_features is None else max_features
    best = top_k(terms, [F.desc("n"), F.asc("term")], keep).select("term", "df")
    frequency = dict(best.collect())
    vocab = sorted(_checked_terms(list(frequency)))
    n_texts = df.count()
    return vocab, [float(np.log((1 + n_texts) / (1 + frequency[t])) + 1) for t in vocab]


def count_vectors(
    df: DataFrame,
    vocab: Sequence[str],
    text: str = "posts",
    out: str = "counts",
    stop_words: Iterable[str] = (),
) -> DataFrame:
    """Sparse count vectors over a fixed vocabulary; narrow."""
    tokens = tx.remove_stop_words(tx.tokenize_words(F.col(text)), stop_words)
    model = CountVectorizerModel.from_vocabulary(list(vocab), inputCol="_tokens", outputCol=out)
    return model.transform(df.withColumn("_tokens", tokens)).drop("_tokens")


def vector_cells(df: DataFrame, col: str, keep: Sequence[str]) -> DataFrame:
    """The non-zero cells of a sparse vector column as rows ``(keep..., idx, value)``."""
    v = F.unwrap_udt(F.col(col))
    cells = F.arrays_zip(v["indices"].alias("idx"), v["values"].alias("value"))
    return df.select(*keep, F.explode(cells).alias("cell")).select(
        *keep, F.col("cell.idx").alias("idx"), F.col("cell.value").alias("value")
    )


# --- TF-IDF -------------------------------------------------------------------

def document_terms(
    df: DataFrame, keep: Sequence[str], text: str, stop_words: Iterable[str] = ()
) -> DataFrame:
    """Rows ``(keep..., term, n)``: term counts of each text, found inside its own row.

    A text is one row, so its tokens are sorted and run-length counted in place;
    no shuffle of tokens is needed. Each ``explode`` of a one-element array
    evaluates its argument once and gives it a name for the next lambda.
    """
    tokens = tx.remove_stop_words(tx.tokenize_words(F.col(text)), stop_words)
    ordered = df.select(*keep, F.explode(F.array(F.array_sort(tokens))).alias("s")).filter(
        F.size("s") > 0
    )
    s = F.col("s")
    starts = F.filter(
        F.sequence(F.lit(0), F.size(s) - 1),
        lambda i: (i == 0) | (F.get(s, i) != F.get(s, F.greatest(i - 1, F.lit(0)))),
    )
    bounds = ordered.select(
        *keep, "s", F.explode(F.array(F.concat(starts, F.array(F.size(s))))).alias("b")
    )
    b = F.col("b")
    runs = F.transform(
        F.slice(b, 1, F.size(b) - 1),
        lambda start, j: F.struct(
            F.get(s, start).alias("term"), (F.get(b, j + 1) - start).cast("long").alias("n")
        ),
    )
    return bounds.select(*keep, F.inline(runs))


def document_frequency(
    df: DataFrame, text: str, stop_words: Iterable[str] = ()
) -> DataFrame:
    """Rows ``(term, df)``: in how many texts a term occurs."""
    tokens = tx.remove_stop_words(tx.tokenize_words(F.col(text)), stop_words)
    return (
        df.select(F.explode(F.array_distinct(tokens)).alias("term"))
        .filter(F.col("term").isNotNull())  # as a join adds it, so the exchange is shared
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
    )


def tfidf_table(
    df: DataFrame,
    id_col: str = "doc_id",
    text: str = "posts",
    stop_words: Iterable[str] = (),
    hot_terms: int = HOT_TERMS,
    frequency: DataFrame | None = None,
    n_texts: int | None = None,
) -> DataFrame:
    """TF-IDF of every term of every text, vocabulary of any size.

    ``frequency (term, df)`` and ``n_texts`` of another corpus may be given, as for
    texts that are scored; terms it lacks are left out. Weight ``n * (ln((1 + texts) / (1 + df)) + 1)``, L2-normalised per text.
    Document frequencies of the ``hot_terms`` most common terms are broadcast (a
    fixed number of rows); only cells of the other terms are shuffled for the
    join. None of those terms can hold more than ``1 / hot_terms`` of all cells,
    so the shuffle has no hot key however common the common words are.

    The norm needs all cells of a text together. Texts are placed by id before
    they are taken apart, and the rare cells are brought to the same places, so
    the union keeps the partitioning and the many common cells never move.
    """
    if frequency is None:
        frequency = document_frequency(df.select(id_col, text), text, stop_words)
    return _weighted_cells(df, id_col, text, stop_words, hot_terms, frequency, n_texts, "term")


def _weighted_cells(
    df: DataFrame, id_col: str, text: str, stop_words: Iterable[str], hot_terms: int, frequency: DataFrame,
    n_texts: int | None, name: str,
) -> DataFrame:
    """``(id, name, weight)`` of :func:`tfidf_table`; ``name``: the column of ``frequency`` that stands for a term."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = df.select(id_col, text)
    hot = broadcast_bounded(
        frequency.orderBy(F.desc("df"), "term").limit(hot_terms), hot_terms
    )
    common = (
        document_terms(texts.repartition(parts, id_col), [id_col], text, stop_words)
        .join(hot, "term")
        .select(id_col, name, "n", "df")
    )
    rare = (
        document_terms(texts, [id_col], text, stop_words)
        .join(hot.select("term"), "term", "left_anti")
        .join(frequency, "term")
        .select(id_col, name, "n", "df")
        .repartition(parts, id_col)
    )
    total = df.agg(F.count(F.lit(1)).cast("double")).scalar() if n_texts is None else F.lit(float(n_texts))
    idf = F.log((F.lit(1.0) + total) / (F.lit(1.0) + F.col("df"))) + 1.0
    weighted = common.unionByName(rare).select(id_col, name, (F.col("n") * idf).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(id_col)))
    return weighted.select(id_col, name, (F.col("w") / norm).alias("weight"))


def tfidf_stages(
    vocab: Sequence[str], weights: Sequence[float], tokens: str, out: str = "features"
) -> list:
    """Fitted ML stages from a token column to L2-normalised TF-IDF vectors.

    MLlib's own ``IDF`` leaves out the ``+ 1``, so the weights are applied with
    an element-wise product.
    """
    return [
        CountVectorizerModel.from_vocabulary(list(vocab), inputCol=tokens, outputCol="_counts"),
        ElementwiseProduct(
            scalingVec=Vectors.dense(list(weights)), inputCol="_counts", outputCol="_weighted"
        ),
        Normalizer(p=2.0, inputCol="_weighted", outputCol=out),
    ]


def hashed_stages(df: DataFrame, width: int, tokens: str, out: str = "features") -> list:
    """As :func:`tfidf_stages` for any vocabulary: every term adds to one of ``width`` columns.

    Document frequencies are those of the columns; only ``width`` numbers pass
    through the driver.
    """
    tf = HashingTF(numFeatures=width, inputCol=tokens, outputCol="_counts")
    idf = IDF(inputCol="_counts", outputCol="_idf").fit(tf.transform(df))
    return [
        tf,
        ElementwiseProduct(
            scalingVec=Vectors.dense(idf.idf.toArray() + 1.0), inputCol="_counts", outputCol="_weighted"
        ),
        Normalizer(p=2.0, inputCol="_weighted", outputCol=out),
    ]


# --- truncated SVD ------------------------------------------------------------

class TruncatedSvd:
    """Project vectors on the first ``k`` right singular vectors, not centred.

    ``solver="randomised"``: a range finder, whose passes only sum (columns x k)
    blocks, so its cost does not grow with the square of the vocabulary.
    ``solver="gram"``: one pass for the Gram matrix, solved exactly; for few columns.
    """

    def __init__(
        self, k: int = SVD_COMPONENTS, col: str = "features", out: str = "svd",
        seed: int = SPLIT_SEED, passes: int = SVD_PASSES, solver: str = "randomised",
    ):
        if solver not in ("randomised", "gram"):
            raise ValueError(f"solver must be 'randomised' or 'gram', not {solver!r}")
        self.k, self.col, self.out, self.seed, self.passes = k, col, out, seed, passes
        self.solver = solver

    def fit(self, df: DataFrame) -> TruncatedSvdModel:
        n = df.select(self.col).first()[0].size
        k = min(self.k, n)
        if n * (k + SVD_OVERSAMPLE) > MAX_MATRIX_CELLS:
            raise ValueError(f"a {n} x {k} projection is too large to ship; lower max_features")
        if self.solver == "gram":
            rows = MLUtils.convertVectorColumnsFromML(df.select(self.col), self.col)
            basis, gram = np.eye(n), RowMatrix(rows).computeGramianMatrix().toArray()
        else:
            start = np.random.default_rng(self.seed).standard_normal((n, min(k + SVD_OVERSAMPLE, n)))
            basis = np.linalg.qr(start)[0]
            for _ in range(self.passes):
                basis = np.linalg.qr(self._gram_times(df, basis))[0]
            gram = basis.T @ self._gram_times(df, basis)
        values, vectors = np.linalg.eigh(gram)
        best = np.argsort(values)[::-1][:k]
        sigma = np.sqrt(np.clip(values[best], 0.0, None))
        return TruncatedSvdModel(sigma, basis @ vectors[:, best], self.col, self.out)

    def _gram_times(self, df: DataFrame, basis: np.ndarray) -> np.ndarray:
        """``A' (A basis)`` for the rows A of the frame.

        Every task sums its own rows into one block and hands on the columns it
        has seen; a grouped sum adds the blocks.
        """
        shipped = df.sparkSession.sparkContext.broadcast(basis)

        def block(batches):
            q = shipped.value
            z, seen = np.zeros_like(q), np.zeros(len(q), dtype=bool)
            for batch in batches:
                for i, x in zip(batch["indices"], batch["values"]):
                    x = np.asarray(x, dtype=float)
                    z[i] += np.outer(x, x @ q[i])
                    seen[i] = True
            for chunk in np.array_split(np.flatnonzero(seen), 1 + int(seen.sum()) // 1000):
                yield pd.DataFrame({"idx": chunk, "sums": list(z[chunk])})

        v = F.unwrap_udt(F.col(self.col))
        blocks = df.select(v["indices"].alias("indices"), v["values"].alias("values")).mapInPandas(
            block, "idx long, sums array<double>"
        )
        total = blocks.groupBy("idx").agg(Summarizer.sum(array_to_vector("sums")).alias("z"))
        product = np.zeros_like(basis)
        for row in total.select("idx", vector_to_array("z").alias("z")).collect():
            product[row["idx"]] = row["z"]
        shipped.unpersist()
        return product


class TruncatedSvdModel:
    """Fitted projection; ``components`` is (columns x k)."""

    def __init__(self, singular_values: np.ndarray, components: np.ndarray, col: str, out: str):
        self.singular_values, self.components = singular_values, components
        self.col, self.out = col, out

    def transform(self, df: DataFrame) -> DataFrame:
        shipped = df.sparkSession.sparkContext.broadcast(self.components)

        @F.pandas_udf("array<double>")
        def project(indices: pd.Series, values: pd.Series) -> pd.Series:
            v = shipped.value
            return pd.Series(
                [np.asarray(x, dtype=float) @ v[i] for i, x in zip(indices, values)]
            )

        cells = F.unwrap_udt(F.col(self.col))
        return df.withColumn(
            self.out, array_to_vector(project(cells["indices"], cells["values"]))
        )


# --- vectors from a vocabulary table -------------------------------------------

def term_ids(terms: DataFrame, term: str = "term", out: str = "idx") -> DataFrame:
    """``terms`` (a row per term) with dense ids from 0 in alphabetical order, any number of them.

    Terms are placed by ranges and sorted in their place; a term's id is the count
    of terms in earlier places and its own rank in its place. The placed table is
    written once, since ranges may be cut otherwise when computed again. Null terms get none.
    """
    within = (1 << 33) - 1  # the part of Spark's number that counts rows within a task
    placed = terms.where(F.col(term).isNotNull()).repartitionByRange(term).sortWithinPartitions(term)
    placed = materialize(placed.withColumn("_number", F.monotonically_increasing_id()), "terms")
    part = F.shiftright("_number", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    # one row per place, of which there are as many as shuffle partitions
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    number = F.col("_offset") + F.col("_number").bitwiseAND(F.lit(within))
    return numbered.withColumn(out, number).drop("_part", "_number", "_offset")


def sparse_vectors(
    cells: DataFrame, ids: DataFrame, id_col: str = "doc_id", hot_terms: int = HOT_TERMS, frequency: str = "df",
) -> DataFrame:
    """``(id, indices, values)`` from cells ``(id, term, weight)`` and ``ids (term, idx, df)``.

    Indices rise. Cells of the ``hot_terms`` most common terms meet a broadcast of
    fixed size, the others are shuffled by term, as in :func:`tfidf_table`. A vector
    is put together from the cells of one text. Texts without a cell have no row;
    cells of terms that ``ids`` lacks are left out.
    """
    hot = broadcast_bounded(
        ids.orderBy(F.desc(frequency), "term").limit(hot_terms).select("term", "idx"), hot_terms)
    common = cells.join(hot, "term").select(id_col, "idx", "weight")
    rare = cells.join(hot.select("term"), "term", "left_anti").join(ids.select("term", "idx"), "term")
    both = common.unionByName(rare.select(id_col, "idx", "weight"))
    vectors = both.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("idx", "weight"))).alias("_cells"))
    return vectors.select(id_col, F.col("_cells.idx").alias("indices"), F.col("_cells.weight").alias("values"))


def tfidf_vectors(
    df: DataFrame, id_col: str = "doc_id", text: str = "posts", stop_words: Iterable[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Sparse TF-IDF vectors of all texts over all their terms, and the table of term ids ``(term, df, idx)``.

    No vocabulary passes through the driver and none is too large. Weights are
    those of :func:`tfidf_table`. A term's id comes with its frequency, and the weights
    are made where a text's cells are together, so no cell moves again.
    """
    ids = term_ids(document_frequency(df, text, stop_words))
    cells = _weighted_cells(df, id_col, text, stop_words, HOT_TERMS, ids.select("term", "df", "idx"), df.count(), "idx")
    vectors = cells.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("idx", "weight"))).alias("_cells"))
    return vectors.select(id_col, F.col("_cells.idx").alias("indices"), F.col("_cells.weight").alias("values")), ids


def as_ml_vectors(vectors: DataFrame, size: int, out: str = "features") -> DataFrame:
    """``indices`` and ``values`` as one MLlib vector; ``size`` below 2^31, which is MLlib's limit."""
    if size >= 1 << 31:
        raise ValueError("an MLlib vector has less than 2^31 columns; work on indices and values")
    vector = F.udf(lambda i, v: Vectors.sparse(size, i, v), VectorUDT())
    return vectors.withColumn(out, vector("indices", "values")).drop("indices", "values")
