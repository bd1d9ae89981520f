"""Versions of fitted state: tables and models that are seen only when they are whole.

A version's data go to a folder of their own; the row of the manifest that names it is
written last. Readers take the newest version of the manifest, so what was interrupted
half-way is never read, and a version that is being replaced stays readable. Tables are
checked against the count and digest their row holds. Everything goes through Spark,
so any storage it can reach will do.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MANIFEST = "version bigint, name string, kind string, folder string, n bigint, digest string"


def _digest(df: DataFrame) -> tuple[int, str]:
    """Row count and a digest that does not depend on the order of rows."""
    cells = F.xxhash64(*(F.col("`" + c.replace("`", "``") + "`") for c in df.columns))
    n, total = df.agg(F.count(F.lit(1)), F.sum(cells.cast("decimal(38,0)"))).first()
    return n, str(total or 0)


class ArtifactStore:
    """Named tables and models below ``path``, by version."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _manifest(self) -> DataFrame:
        try:
            return self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest")
        except AnalysisException:  # nothing has been saved yet
            return self.spark.createDataFrame([], _MANIFEST)

    def versions(self) -> list[int]:
        """Whole versions, oldest first: a number per save."""
        return sorted(r[0] for r in self._manifest().select("version").distinct().collect())

    def save(self, tables: Mapping[str, DataFrame] | None = None, models: Mapping[str, PipelineModel] | None = None) -> int:
        """Write a new version and return its number; the manifest names it when all is written."""
        version = max(self.versions(), default=0) + 1
        folder = f"data/{version}-{uuid.uuid4().hex}"
        rows = []
        for name, df in (tables or {}).items():
            df.write.parquet(f"{self.path}/{folder}/{name}")
            written = self.spark.read.schema(df.schema).parquet(f"{self.path}/{folder}/{name}")
            rows.append((version, name, "table", folder, *_digest(written)))
        for name, model in (models or {}).items():
            model.save(f"{self.path}/{folder}/{name}")
            rows.append((version, name, "model", folder, 0, ""))
        if not rows:
            raise ValueError("a version needs a table or a model")
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        return version

    def _row(self, name: str, kind: str, version: int | None):
        rows = self._manifest().where((F.col("name") == name) & (F.col("kind") == kind))
        if version is not None:
            rows = rows.where(F.col("version") == version)
        # two saves at once may take the same number; the folder settles which one counts
        row = rows.orderBy(F.desc("version"), F.desc("folder")).first()
        if row is None:
            raise FileNotFoundError(f"no {kind} {name!r}" + (f" of version {version}" if version is not None else "") + f" in {self.path}")
        return row

    def table(self, name: str, version: int | None = None) -> DataFrame:
        """A table of the newest version that has it, or of ``version``; damaged ones raise ``ValueError``."""
        row = self._row(name, "table", version)
        df = self.spark.read.parquet(f"{self.path}/{row['folder']}/{name}")
        if _digest(df) != (row["n"], row["digest"]):
            raise ValueError(f"table {name!r} of version {row['version']} is not what was saved")
        return df

    def model(self, name: str, version: int | None = None) -> tuple[int, PipelineModel]:
        """Version and model, the newest unless ``version`` is given."""
        row = self._row(name, "model", version)
        return row["version"], PipelineModel.load(f"{self.path}/{row['folder']}/{name}")
