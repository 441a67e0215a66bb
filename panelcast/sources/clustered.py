"""Panel tables clustered by key: windows and joins by key read them without a shuffle.

Rows are dealt into a fixed number of buckets by key when they are written, and sorted by key and time inside a
bucket. Spark knows this from the catalog, so a window per key, or a join of two tables with equal keys and
buckets, starts from the files as they lie. Months are folders, as in the plain store, and an upsert
rewrites the touched months only, bucket by bucket.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.session import fresh_folder
from panelcast.sources.store import latest_per_pk, merge_rows

PART = "month_part"


@dataclass(frozen=True)
class ClusteredTable:
    """A catalog table; give tables that are joined the same number of buckets."""

    spark: SparkSession
    name: str
    keys: tuple[str, ...]
    event_time: str
    buckets: int = 64

    @property
    def primary_key(self) -> tuple[str, ...]:
        return (*self.keys, self.event_time)

    def _dealt(self, df: DataFrame) -> DataFrame:
        month = F.date_format(self.event_time, "yyyy-MM").alias(PART)
        # a file per bucket and month: the tasks are the buckets
        return df.select("*", month).repartition(self.buckets, *self.keys)

    def create(self, rows: DataFrame, path: str | None = None) -> None:
        """Write ``rows``, one per primary key, as a new table, below ``path`` or in the shared folder."""
        folder = path or fresh_folder(self.spark, "clustered")
        (
            self._dealt(latest_per_pk(rows, self.primary_key, ()))
            .write.format("parquet").option("path", folder)
            .partitionBy(PART).bucketBy(self.buckets, *self.keys).sortBy(*self.primary_key)
            .saveAsTable(self.name)
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.name).drop(PART)

    def upsert(self, batch: DataFrame, newest: Sequence[str] = ()) -> None:
        """Replace rows with equal primary key and add the rest, in the months of ``batch``; buckets stay."""
        columns = self.read().columns
        batch = latest_per_pk(batch, self.primary_key, newest).select(*columns).persist()
        try:
            months = [r[0] for r in batch.select(F.date_format(self.event_time, "yyyy-MM")).distinct().collect()]  # a string each
            if months:
                held = self.spark.table(self.name).where(F.col(PART).isin(months)).drop(PART)
                merged = self._dealt(merge_rows(held, batch, self.primary_key))
                # written beside the table first, as its own folders are replaced
                folder = fresh_folder(self.spark, "clustered-months")
                merged.write.parquet(folder)
                ready = self.spark.read.parquet(folder).select(*columns, PART).repartition(self.buckets, *self.keys)
                with _dynamic(self.spark):
                    ready.write.mode("overwrite").insertInto(self.name)
        finally:
            batch.unpersist()


class _dynamic:
    """Overwriting replaces the months that are written, not the table."""

    setting = "spark.sql.sources.partitionOverwriteMode"

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self) -> None:
        self.before = self.spark.conf.get(self.setting)
        self.spark.conf.set(self.setting, "dynamic")

    def __exit__(self, *_: object) -> None:
        self.spark.conf.set(self.setting, self.before)
