"""Fitted state on storage: vocabularies, label maps and models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def save_encoders(vocab: DataFrame, classes: Sequence[str], path: str) -> None:
    """Write a sequence vocabulary and the class list as parquet tables."""
    spark = vocab.sparkSession
    vocab.write.mode("overwrite").parquet(f"{path}/vocabulary")
    labels = spark.createDataFrame(list(enumerate(classes)), "label int, type string")
    labels.coalesce(1).write.mode("overwrite").parquet(f"{path}/labels")


def load_encoders(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """The vocabulary frame and the class list in index order."""
    labels = spark.read.parquet(f"{path}/labels").orderBy("label").select("type").collect()
    return spark.read.parquet(f"{path}/vocabulary"), [row[0] for row in labels]


def save_model(model: PipelineModel, path: str, classes: Sequence[str] | None = None) -> None:
    """Write a fitted pipeline, replacing an older one; classes go next to it."""
    model.write().overwrite().save(f"{path}/model")
    if classes is not None:
        spark = SparkSession.active()
        labels = spark.createDataFrame(list(enumerate(classes)), "label int, type string")
        labels.coalesce(1).write.mode("overwrite").parquet(f"{path}/labels")


def load_model(path: str) -> PipelineModel:
    """Read a fitted pipeline."""
    return PipelineModel.load(f"{path}/model")


def load_classes(spark: SparkSession, path: str) -> list[str]:
    """Class names in index order, as saved with a model."""
    rows = spark.read.parquet(f"{path}/labels").orderBy(F.col("label")).collect()
    return [row["type"] for row in rows]
