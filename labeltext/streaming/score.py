"""Scoring texts as they arrive. Stateless: no watermark, no state store."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from labeltext.constants import TYPE_DESCRIPTIONS
from labeltext.operators.scoring import score_texts


def read_text_stream(
    spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """A folder as a stream of files; ``files_per_batch`` bounds a micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def score_stream(
    model: PipelineModel,
    stream: DataFrame,
    classes: Sequence[str],
    path: str,
    checkpoint: str,
    text: str = "posts",
    descriptions: Mapping[str, str] = TYPE_DESCRIPTIONS,
    available_now: bool = True,
) -> StreamingQuery:
    """Score a stream into a parquet folder.

    The file sink and its checkpoint make the output exactly-once when a task or
    the driver is restarted. ``available_now`` handles what is there in bounded
    batches and stops; otherwise the query keeps running.
    """
    writer = (
        score_texts(model, stream, classes, text, descriptions)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)
