"""How the given tables are read as raw posts, training corpus and predictions.

The tables carry no label codes, so codes and flairs are derived from other
columns. The derivations are plain SQL that Spark and DuckDB read alike; both
sides of every check use the same text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: A four-letter code from language, length, source and a hash of the text.
CODE = (
    "(case when lang = 'en' then 'I' else 'E' end"
    " || case when n_chars > 1500 then 'N' else 'S' end"
    " || case when length(source) = 4 then 'T' else 'F' end"
    " || case when substr(md5(text), 1, 1) < '8' then 'J' else 'P' end)"
)

#: A flair: missing, without a code, with the code inside a longer word, with two.
FLAIR = (
    "(case when source = 'src7' then null"
    " when source = 'src8' then 'new here'"
    f" when source = 'src9' then 'ex-' || lower({CODE}) || '_x or not'"
    f" when source = 'src10' then {CODE} || '/ENFP'"
    f" else 'x ' || lower({CODE}) || ' 5w4' end)"
)

#: Words that stand for codes in the leakage filter, so that it removes rows.
LEAK_WORDS = ("DES", "UND")

#: Class of a score vector and of a prediction over the embeddings.
CLASS_NAMES = tuple(f"c{i}" for i in range(64))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A text table as it is stored, or over as many tasks as the caller asks for.

    ``spark.labeltext.partitions`` is for small tables in one row group, which one
    task would read; unset, nothing is moved.
    """
    wanted = spark.conf.get("spark.labeltext.partitions", None)
    df = table(spark, sf_dir, name)
    return df.repartition(int(wanted), key) if wanted else df


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as raw posts."""
    return texts(spark, sf_dir, "documents", "doc_id").selectExpr(
        "doc_id AS row_id", f"{FLAIR} AS author_flair_text", "text AS body"
    )


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as training corpus, code as class."""
    return texts(spark, sf_dir, "documents", "doc_id").selectExpr(
        "doc_id", f"{CODE} AS type", "text AS posts"
    )


def by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as training corpus, language as class."""
    return texts(spark, sf_dir, "documents", "doc_id").selectExpr(
        "doc_id", "lang AS type", "text AS posts"
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two label columns read as truth and prediction."""
    return table(spark, sf_dir, "labels").selectExpr(
        "doc_id", "quality AS label", "1 - toxic AS prediction"
    )
