"""The numbered operators over the given tables, one thin query each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labeltext.llm import (
    ann, bpe, conversations, fingerprints, lexical, mixing, neardup, secrets, substrings, suffixtree, tokenfile, toxicity,
    urls,
)
from labeltext.llm.sql import ORACLE
from labeltext.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learnt = suffixtree.learn(docs.where(~suffixtree.held_out(F.col("doc_id"))))
    scored = suffixtree.score(docs, *learnt)
    return scored.withColumn("held_out", suffixtree.held_out(F.col("doc_id")))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode_texts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN, keep_ids=False,
    )


def op3_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


def op4_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # two runs: the first fills the ledger, the second finds nothing unseen and joins back to all paths
    found = secrets.scan_documents(docs, ledger=secrets.update_ledger(docs))
    names = tuple(r.kind for r in secrets.RULES)
    counts = [
        F.expr(f"cast(size(filter(findings, x -> x.place = {i})) as bigint)").alias(f"n_{r.kind}")
        for i, r in enumerate(secrets.BASE_RULES)
    ]
    base = secrets.joined(F.col("findings"), names[: len(secrets.BASE_RULES)])
    return found.select(
        "doc_id", *counts, F.sha2(base, 256).alias("base_sha256"),
        secrets.joined(F.col("findings"), names).alias("spans"),
    )


def op5_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), keep_text=False)


def op6_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), k=4)


def op7_url_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op8_vp_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op9_pu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.trained(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


#: Target weights of the sources, in parts; any other source belongs to the rest.
SOURCE_PARTS = {"src0": 8, **{f"src{i}": 2 for i in range(1, 10)}, **{f"src{i}": 1 for i in range(10, 20)}}


def op10_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    mixed = mixing.interleave(docs, SOURCE_PARTS)
    return mixed.select(
        "doc_id", "source", F.col("_block").alias("block"), F.col("_release").alias("release"),
        F.col("_due").alias("due"), F.col("_slot").alias("slot"), F.col("_offset").alias("offset"),
    )


def op11_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(table(spark, sf_dir, "conversations"), damage=True)


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "token-files")
    tokenfile.write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return tokenfile.read_token_files(spark, path, keep_ids=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_tree": op1_suffix_tree,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_winnowing": op3_winnowing,
    "op4_secret_ledger": op4_secret_ledger,
    "op5_recompression": op5_recompression,
    "op6_lsh_forest": op6_lsh_forest,
    "op7_url_words": op7_url_words,
    "op8_vp_trees": op8_vp_trees,
    "op9_pu_toxicity": op9_pu_toxicity,
    "op10_pfair_mix": op10_pfair_mix,
    "op11_norm_buckets": op11_norm_buckets,
    "op12_turn_repair": op12_turn_repair,
    "op13_token_files": op13_token_files,
}

__all__ = ["ORACLE", "QUERIES", "SOURCE_PARTS"]
