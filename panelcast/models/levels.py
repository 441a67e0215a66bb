"""A key as one ordered number, so that trees split keys without a place for each.

A key's level says how far the labels of its earlier rows lie from those of all keys, drawn to 0 while there
are few: (sum - n * mean of all) / (n + ``SHRINK``). A tree splits by order alone, so the level stands for the
key's rank. A training row gets the level its key had on that day, from labels known by then, never its own: a
label ``gap`` rows ahead is known ``gap`` rows later. New rows get the level after all training rows, from a
stored table. A key that training didn't see, or no key, has level 0, as a key without known labels.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.session import saved

LEVEL = "_key_level"
SHRINK = 1.0


def _level(total: str, n: str, all_total: str, all_n: str) -> Column:
    away = F.col(total) - F.col(n) * F.col(all_total) / F.col(all_n)
    return F.when(F.col(n) > 0, away / (F.col(n) + F.lit(SHRINK))).otherwise(F.lit(0.0))


def _daily(rows: DataFrame, label: str, key: str, time: str) -> DataFrame:
    """A key's label sum and count per time: one row however often a time is repeated."""
    per = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k"), F.col(time).alias("_t"))
    return per.agg(F.sum(F.col(label).cast("double")).alias("_s"), F.count(label).alias("_n"))


def running_levels(rows: DataFrame, label: str, key: str = "city", time: str = "date", gap: int = 1) -> DataFrame:
    """``(_k, _t, LEVEL)``: every key's level at every time of ``rows``.

    Labels become known ``gap`` rows of their key later. One window per key, over a row per time, and one over the
    times, of which there are few."""
    order = Window.partitionBy("_k").orderBy("_t")
    known = _daily(rows, label, key, time).select(
        "_k", "_t", *(F.coalesce(F.lag(c, gap).over(order), F.lit(0)).alias(c) for c in ("_s", "_n"))
    )
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    keys = known.select("_k", "_t", F.sum("_s").over(so_far).alias("_s"), F.sum("_n").over(so_far).alias("_n"))
    times = known.groupBy("_t").agg(F.sum("_s").alias("_as"), F.sum("_n").alias("_an"))
    up_to = Window.orderBy("_t").rowsBetween(Window.unboundedPreceding, 0)
    times = times.select("_t", F.sum("_as").over(up_to).alias("_as"), F.sum("_an").over(up_to).alias("_an"))
    return keys.join(times, "_t").select("_k", "_t", _level("_s", "_n", "_as", "_an").alias(LEVEL))


def last_levels(rows: DataFrame, label: str, key: str = "city") -> DataFrame:
    """``(_k, LEVEL)``: every key's level after all of ``rows``."""
    value = F.col(label).cast("double")
    per = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.sum(value).alias("_s"), F.count(label).alias("_n"))
    every = per.agg(F.sum("_s").alias("_as"), F.sum("_n").alias("_an"))
    return per.join(every).select("_k", _level("_s", "_n", "_as", "_an").alias(LEVEL))


def with_running_levels(rows: DataFrame, label: str, key: str = "city", time: str = "date", gap: int = 1) -> DataFrame:
    """``rows`` with the level their key had at their time."""
    found = running_levels(rows, label, key, time, gap)
    joined = rows.join(found, (F.col(key) == F.col("_k")) & (F.col(time) == F.col("_t")), "left")
    return joined.select(*(rows[c] for c in rows.columns), F.coalesce(F.col(LEVEL), F.lit(0.0)).alias(LEVEL))


@dataclass(frozen=True)
class Levelled:
    """A pipeline that reads the raw columns and the key's level, with the table of levels."""

    name: str
    model: PipelineModel
    features: tuple[str, ...]
    key: str
    levels: DataFrame
    params: dict[str, Any] = field(default_factory=dict)

    form = "levelled"

    def score(self, df: DataFrame, prediction: str = "prediction") -> DataFrame:
        """``df`` with one more column; the levels find their rows by a join whose strategy follows their measured size."""
        known = df.join(self.levels, df[self.key] == self.levels["_k"], "left").drop("_k")
        scored = self.model.transform(known.fillna(0.0, [LEVEL]))
        return scored.select(*df.columns, F.col("prediction").alias(prediction))

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/pipeline")
        self.levels.write.mode("overwrite").parquet(f"{path}/levels")

    @staticmethod
    def load(spark: SparkSession, path: str, name: str, features: Sequence[str], key: str) -> Levelled:
        return Levelled(name, PipelineModel.load(f"{path}/pipeline"), tuple(features), key, spark.read.parquet(f"{path}/levels"))


def stored_levels(rows: DataFrame, label: str, key: str) -> DataFrame:
    return saved(last_levels(rows, label, key), "key-levels")
