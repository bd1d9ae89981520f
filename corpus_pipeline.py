"""From raw documents to token ids: five stages over the numbered operators.

Each stage takes what the one before it kept and returns the columns of
``documents``, the last one token ids. ``run`` writes every stage as Parquet to the
shared folder and reads it back, so a lost executor never costs an earlier stage.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labeltext.llm import bpe, mixing, neardup, secrets, toxicity
from labeltext.llm.names import free_name, quoted
from labeltext.llm.queries import SOURCE_PARTS
from labeltext.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under the threshold; null and empty texts stay."""
    model = toxicity.trained(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(toxicity.probability(F.col("text"), model) < toxicity.THRESHOLD)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near copies."""
    return neardup.drop_near_duplicates(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced; ``n_chars`` follows the text."""
    before = free_name("before", docs.columns)
    out = secrets.redact_documents(docs.withColumn(before, F.xxhash64("text")))
    changed = F.xxhash64("text") != F.col(before)
    n_chars = F.when(changed, F.char_length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", n_chars).drop(before)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each once, in the order of the mix: files and their rows follow the slots.

    Null sources, ids and texts are rows like others; an empty table stays empty.
    """
    mixed = mixing.interleave(docs, SOURCE_PARTS)
    names = mixing.result_names(docs.columns)
    order = [names["slot"], names["offset"]]
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = mixed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return ordered.select(*map(quoted, docs.columns))


def mix_position(docs: DataFrame, keep: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """``keep`` columns of ``docs``, as read from the files of the mix, with ``position``: row n of the mix, from 0.

    Files follow one another by name and rows by their place in the file; only one row
    per file is counted together. Rows that were not read from files have no position.
    """
    try:
        placed = docs.select(*keep, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_at"))
    except AnalysisException:
        return docs.select(*keep, F.lit(None).cast("bigint").alias("position"))
    files = placed.groupBy("_file").agg(F.count("*").alias("_n"))
    name = F.element_at(F.split("_file", "/"), -1)
    before = Window.orderBy(F.length(name), name).rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    placed = placed.join(F.broadcast(starts), "_file")  # a row per file
    return placed.withColumn("position", F.col("_start") + F.col("_at")).drop("_file", "_at", "_start")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with its place in the mix and digests of the ids and of the decoded bytes.

    A null text has no tokens; rows that share an id get a row each; an empty table stays empty.
    """
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    # the place travels with the id, which need not be unique
    placed = mix_position(docs).select(F.struct("doc_id", "position").alias("_place"), "text")
    coded = bpe.encode_texts(placed, path, public_tokenizers.PATTERN, id_col="_place")
    rest = [c for c in coded.columns if c != "_place"]
    return coded.select("_place.doc_id", "_place.position", *rest)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_copies),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("encoding", encode),
]

#: SQL cannot train the model of the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
