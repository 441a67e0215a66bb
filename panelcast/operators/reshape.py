"""Unions, wide-to-long, and one-hot keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Key levels that may become one column each; beyond it plans grow too wide.
MAX_LEVEL_COLUMNS = 500


def union_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """By column name; a column a frame lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def observed_and_forecast(
    observed: DataFrame,
    forecast: DataFrame,
    keys: Sequence[str] = ("city",),
    date: str = "date",
    value: str = "pm2_5",
    target_date: str = "target_date",
    prediction: str = "prediction",
) -> DataFrame:
    """One long series ``(keys, date, value, series)``."""
    seen = observed.select(
        *keys, F.col(date).alias("date"), F.col(value).alias("value"), F.lit("Observed").alias("series")
    )
    ahead = forecast.select(
        *keys,
        F.col(target_date).alias("date"),
        F.col(prediction).alias("value"),
        F.lit("Forecast").alias("series"),
    )
    return seen.unionByName(ahead)


def to_long(
    df: DataFrame, ids: Sequence[str], columns: Mapping[str, str], name: str, value: str
) -> DataFrame:
    """One row per id and column; ``columns`` maps a column to its label."""
    labelled = df.select(*ids, *(F.col(c).alias(label) for c, label in columns.items()))
    return labelled.unpivot(list(ids), list(columns.values()), name, value)


class TooManyLevels(ValueError):
    """A key has more levels than may become columns."""


def key_levels(df: DataFrame, key: str, limit: int = MAX_LEVEL_COLUMNS) -> list[str]:
    """The distinct keys in order, if there are at most ``limit``; else an error.

    At most ``limit + 1`` strings reach the driver.
    """
    rows = df.select(key).where(F.col(key).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise TooManyLevels(f"more than {limit} levels of {key}: encode them as a sparse vector")
    return sorted(r[0] for r in rows)


def one_hot(key: str, levels: Sequence[str]) -> dict[str, Column]:
    """A 0/1 column per level. A key outside the levels is 0 everywhere."""
    return {
        f"{key}_{level}": F.coalesce(F.col(key) == F.lit(level), F.lit(False)).cast("double")
        for level in levels
    }


def align_columns(df: DataFrame, columns: Sequence[str], fill: float = 0.0) -> DataFrame:
    """Exactly ``columns``, in order; those absent are filled, others dropped."""
    have = set(df.columns)
    return df.select(*(F.col(f"`{c}`") if c in have else F.lit(fill).alias(c) for c in columns))
