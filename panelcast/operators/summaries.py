"""Column profiles of any span of months from stored, mergeable summaries.

For every key, month and column one row is kept: counts, extremes, moments, a quantile sketch (KLL) and a
distinct-count sketch (HyperLogLog). Rows of a span add up to its profile, so a year is profiled without
reading its rows. Counts, extremes, mean and deviation are exact; quartiles and distinct counts are
estimates, with their error bounds beside them (``profile.describe`` is the exact form).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.operators.profile import QUARTILES
from panelcast.sources.store import KeyedTable, PanelStore

KEY, KNOWN, MONTH, COLUMN = "key", "known", "month", "column"
# Sizes of the sketches, and their published errors (fixed values): of a quantile's rank, and of a distinct count (one standard error).
KLL_K, HLL_LG_K = 400, 12
RANK_ERROR = 2.296 / KLL_K**0.9723
DISTINCT_ERROR = 1.04 / (1 << HLL_LG_K) ** 0.5


def summaries(rows: DataFrame, columns: Sequence[str], key: str, time: str) -> DataFrame:
    """A row per key, month and column. Rows without a key are a key of their own: ``known`` is false."""
    long = rows.select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias(KEY), F.col(key).isNotNull().alias(KNOWN), F.trunc(time, "month").alias(MONTH),
        *(F.col(c).cast("double").alias(c) for c in columns),
    ).unpivot([KEY, KNOWN, MONTH], list(columns), COLUMN, "value")
    value = F.col("value")
    return long.groupBy(KEY, KNOWN, MONTH, COLUMN).agg(
        F.count("value").alias("n"), F.count_if(value.isNull()).alias("nulls"), F.min("value").alias("min"), F.max("value").alias("max"),
        F.avg("value").alias("mean"), (F.var_pop("value") * F.count("value")).alias("squares"),
        F.kll_sketch_agg_double("value", F.lit(KLL_K)).alias("ranks"), F.hll_sketch_agg(F.when(value.isNotNull(), F.xxhash64("value")), F.lit(HLL_LG_K)).alias("kinds"),
    )


@dataclass(frozen=True)
class SummaryTable:
    table: KeyedTable
    columns: tuple[str, ...]
    key: str = "city"
    time: str = "date"

    @staticmethod
    def in_store(store: PanelStore, name: str, columns: Sequence[str], key: str = "city", time: str = "date") -> SummaryTable:
        table = store.get_or_create(name, (KEY, KNOWN, MONTH, COLUMN), MONTH)
        return SummaryTable(table, tuple(columns), key, time)

    def update(self, rows: DataFrame) -> None:
        """Put the summaries of ``rows`` in place of those of their keys and months: give whole months."""
        self.table.upsert(summaries(rows, self.columns, self.key, self.time))

    def profile(self, since: dt.date | None = None, until: dt.date | None = None, per_key: bool = False) -> DataFrame:
        """``column, n, nulls, mean, std, min, p25, p50, p75, max, rank_error, kinds, kinds_error`` of the months from that of
        ``since`` to that of ``until``, of all keys or each."""
        parts = self.table.read(None if since is None else since.replace(day=1), until)
        by = [*([KEY, KNOWN] if per_key else []), COLUMN]
        mean = F.sum(F.col("n") * F.col("mean")) / F.sum("n")
        whole = parts.groupBy(*by).agg(mean.alias("all_mean"))
        near = parts.join(whole, by).withColumn("moved", F.col("squares") + F.col("n") * (F.col("mean") - F.col("all_mean")) ** 2)
        found = near.groupBy(*by).agg(
            F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.first("all_mean").alias("mean"), F.sum("moved").alias("moved"),
            F.min("min").alias("min"), F.max("max").alias("max"),
            F.kll_merge_agg_double("ranks", F.lit(KLL_K)).alias("ranks"), F.hll_union_agg("kinds").alias("kinds"),
        )
        std = F.when(F.col("n") > 1, F.sqrt(F.col("moved") / (F.col("n") - 1)))
        points = [F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("ranks", F.lit(q))).alias(name) for name, q in QUARTILES.items()]
        return found.select(
            *by, "n", "nulls", "mean", std.alias("std"), "min", *points, "max", F.lit(RANK_ERROR).alias("rank_error"),
            F.hll_sketch_estimate("kinds").alias("kinds"), F.lit(DISTINCT_ERROR).alias("kinds_error"),
        )
