"""Scoring a stream with the newest saved model, batch by batch.

Every micro-batch goes to a folder named by its number and is then entered in a ledger
with the model's version. A batch that is run again after a failure overwrites its
folder with the same version or, if the ledger has it, is left alone; readers see
the batches of the ledger only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from labeltext.constants import TYPE_DESCRIPTIONS
from labeltext.operators.scoring import score_texts
from labeltext.sources.store import ArtifactStore

_LEDGER = "batch bigint, version bigint, n bigint"


def batch_ledger(spark: SparkSession, path: str) -> DataFrame:
    """``(batch, version, n)`` of the batches that are whole."""
    try:
        return spark.read.schema(_LEDGER).parquet(f"{path}/ledger").dropDuplicates(["batch"])
    except AnalysisException:  # no batch yet
        return spark.createDataFrame([], _LEDGER)


def scored_batches(spark: SparkSession, path: str) -> DataFrame:
    """All scored rows with ``batch`` and ``version``."""
    rows = spark.read.option("basePath", f"{path}/batches").parquet(f"{path}/batches")
    return rows.withColumn("batch", F.col("batch").cast("bigint")).join(
        F.broadcast(batch_ledger(spark, path).select("batch", "version")), "batch")  # a row per batch


def score_stream_by_version(
    store: ArtifactStore,
    stream: DataFrame,
    path: str,
    checkpoint: str,
    text: str = "posts",
    model: str = "model",
    classes: str = "classes",
    descriptions: Mapping[str, str] = TYPE_DESCRIPTIONS,
    available_now: bool = True,
) -> StreamingQuery:
    """Score ``stream`` below ``path`` with the newest ``model`` that ``store`` has when a batch begins.

    The store's table ``classes (label, type)`` of the same version names the classes. Empty
    texts are left out. The ledger makes the output exactly-once: a batch counts when its
    rows are written, and counts once.
    """
    loaded: dict[int, tuple] = {}

    def score(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        own = ArtifactStore(spark, store.path)
        if batch_ledger(spark, path).where(F.col("batch") == number).take(1):
            return
        newest = max(own.versions())
        if newest not in loaded:
            loaded.clear()
            rows = own.table(classes, newest).orderBy("label").collect()
            loaded[newest] = own.model(model, newest)[1], [r["type"] for r in rows]
        fitted, names = loaded[newest]
        folder = f"{path}/batches/batch={number}"
        score_texts(fitted, batch, names, text, descriptions).write.mode("overwrite").parquet(folder)
        n = spark.read.parquet(folder).count()
        entry = spark.createDataFrame([(number, newest, n)], _LEDGER)
        entry.coalesce(1).write.mode("append").parquet(f"{path}/ledger")

    writer = stream.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
