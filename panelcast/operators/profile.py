"""One-pass table profiles, returned as long tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.operators.ranks import quantiles, read_tallies, tally_columns
from panelcast.session import saved


def _long(row: DataFrame, columns: Sequence[str], value: str) -> DataFrame:
    return row.unpivot([], list(columns), "column", value)


def null_counts(df: DataFrame) -> DataFrame:
    """``(column, nulls)``."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns))
    return _long(counts, df.columns, "nulls")


def column_profile(df: DataFrame) -> DataFrame:
    """``(position, column, type, non_null)``."""
    counts = _long(df.agg(*(F.count(c).alias(c) for c in df.columns)), df.columns, "non_null")
    types = F.create_map(
        *(F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString()))
    )
    positions = F.create_map(*(F.lit(x) for i, c in enumerate(df.columns) for x in (c, i)))
    return counts.select(
        positions[F.col("column")].cast("bigint").alias("position"),
        "column",
        types[F.col("column")].alias("type"),
        "non_null",
    )


def time_extent(df: DataFrame, time: str) -> DataFrame:
    return df.agg(F.min(time).alias("first"), F.max(time).alias("last"))


def key_inventory(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys).distinct()


def shape(df: DataFrame) -> DataFrame:
    """``(rows, columns)``."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "columns", F.lit(len(df.columns)).cast("bigint")
    )


def drop_accounting(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows before and after ``complete(df, columns)``, in one pass."""
    whole = F.lit(True)
    for c in columns:
        whole = whole & F.col(c).isNotNull()
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"), F.count_if(whole).alias("rows_after")
    ).withColumn("dropped", F.col("rows_before") - F.col("rows_after"))


QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per column.

    The columns are saved first: ``df`` is computed once, every pass reads the saved columns.
    """
    if columns is None:
        columns = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    df = saved(df.select(*columns), "columns")
    stats = df.agg(
        *tally_columns(columns),
        *(
            F.struct(
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(f"_stats_{c}")
            for c in columns
        ),
    ).first()
    points = quantiles(df, columns, list(QUARTILES.values()), tallies=read_tallies(stats, columns))
    rows = [
        (c, s["count"], s.mean, s.std, s.min, *points[c], s.max)
        for c, s in ((c, stats[f"_stats_{c}"]) for c in columns)
    ]
    quartiles = ", ".join(f"{q} double" for q in QUARTILES)
    return df.sparkSession.createDataFrame(
        rows,
        f"column string, count bigint, mean double, std double, min double, {quartiles}, max double",
    )
