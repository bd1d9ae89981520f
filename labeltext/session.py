"""Session helpers: builder, shared scratch folder, checked broadcast."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: A frame is only hinted for broadcast when its row count is known to stay
#: below this bound (a few MB for the narrow tables it is used on).
BROADCAST_ROW_BOUND = 200_000


def build_session(app: str = "labeltext", **conf: str) -> SparkSession:
    """A session with the settings the package is tuned for.

    Only settings that help on any cluster are made here. Parallelism, memory
    and ``spark.checkpoint.dir`` belong to the cluster and may be passed in.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where the setting is absent a local master gets a fresh temporary folder;
    a real cluster must name one, because a machine-local folder would be lost
    with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    configured = configured or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="labeltext-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; never reused."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Jobs that start here remove their shuffle files when they end, not when the driver collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def materialize(df: DataFrame, name: str, schema: StructType | None = None) -> DataFrame:
    """Cut lineage by writing to the shared folder and reading back, as ``schema`` if given.

    Unlike a cache the result survives the loss of executors, and later jobs
    read only the columns they need. The shuffle files of the job go with it.
    """
    path = scratch_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(schema or df.schema).parquet(path)
    out._written = path
    return out


def discard(df: DataFrame) -> None:
    """Remove what :func:`materialize` wrote and returned as ``df``; nothing may read it any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._written)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def broadcast_bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint ``df`` for broadcast only if it is known to have few rows.

    ``max_rows`` is a bound the caller can prove (a ``limit``, a fixed list).
    Above the bound the frame is returned as it is and the join shuffles.
    """
    return F.broadcast(df) if max_rows <= BROADCAST_ROW_BOUND else df
