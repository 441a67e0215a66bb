"""Saved models with their metrics, by name and version.

``<root>/_models`` holds a folder with one row per version; the model lies next to it. A version is
claimed by creating a file that must not exist yet, which a file system does for one of several writers only, so
writers that register at once get different versions. A version is listed once its model is saved.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.models.absorb import AbsorbedLinear
from panelcast.models.fit import Fitted
from panelcast.models.levels import Levelled
from panelcast.sources.store import create_file, path_exists

MODELS = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("version", T.IntegerType(), False),
        T.StructField("kind", T.StringType()),
        T.StructField("form", T.StringType(), False),
        T.StructField("description", T.StringType()),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("features", T.ArrayType(T.StringType()), False),
        T.StructField("key", T.StringType()),
    ]
)


class ModelRegistry:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    @property
    def _rows_path(self) -> str:
        return f"{self.root}/_models"

    def models(self) -> DataFrame:
        if not path_exists(self.spark, self._rows_path):
            return self.spark.createDataFrame([], MODELS)
        # rows of older registries lie in the folder itself
        return self.spark.read.schema(MODELS).option("recursiveFileLookup", True).parquet(self._rows_path)

    def _path(self, name: str, version: int) -> str:
        return f"{self.root}/{name}/v{version}"

    def register(
        self,
        name: str,
        fitted: Fitted | AbsorbedLinear | Levelled,
        metrics: Mapping[str, float],
        description: str | None = None,
    ) -> int:
        """Save the model as the next version, with metrics as measured."""
        last = self.models().where(F.col("name") == name).agg(F.max("version")).first()[0]
        version = (last or 0) + 1
        while not create_file(self.spark, f"{self._path(name, version)}.claim"):
            version += 1
        fitted.save(self._path(name, version))
        row = (
            name, version, fitted.name, fitted.form, description,
            {k: float(v) for k, v in metrics.items()}, list(fitted.features), fitted.key,
        )
        self.spark.createDataFrame([row], MODELS).coalesce(1).write.parquet(f"{self._rows_path}/{name}-{version}")
        return version

    def load(self, name: str, version: int | str = "latest") -> Fitted | AbsorbedLinear | Levelled:
        rows = self.models().where(F.col("name") == name)
        if version != "latest":
            rows = rows.where(F.col("version") == version)
        row = rows.orderBy(F.col("version").desc()).first()
        if row is None:
            raise KeyError(f"no model {name} version {version}")
        path = self._path(name, row.version)
        if row.form == AbsorbedLinear.form:
            return AbsorbedLinear.load(self.spark, path, row.kind, row.features, row.key)
        if row.form == Levelled.form:
            return Levelled.load(self.spark, path, row.kind, row.features, row.key)
        return Fitted(row.kind, PipelineModel.load(path), tuple(row.features), row.key)
