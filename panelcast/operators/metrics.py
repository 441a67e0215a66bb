"""Forecast errors: overall, per key, and the worst single rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.bands import HAZARD_LEVEL, is_hazard
from panelcast.functions.numbers import half_even, residual


def with_error(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Adds ``error`` = actual - predicted on the row itself."""
    return df.withColumn("error", residual(actual, predicted))


def r2_column(actual: Column, predicted: Column) -> Column:
    """Coefficient of determination in one pass.

    The total sum of squares comes from ``var_pop``, which merges centred
    moments and so does not cancel for values far from zero. A constant actual
    scores 1 when hit exactly and 0 otherwise.
    """
    both = actual.isNotNull() & predicted.isNotNull()
    misfit = F.sum((actual - predicted) * (actual - predicted))
    total = F.var_pop(F.when(both, actual)) * F.count(F.when(both, actual))
    return F.when(total > 0, F.lit(1.0) - misfit / total).when(
        total == 0, F.when(misfit == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    )


def regression_metrics(
    df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()
) -> DataFrame:
    """``(by..., n, mae, rmse, r2)`` over rows that have both values."""
    a, p = F.col(actual), F.col(predicted)
    error = a - p
    return df.groupBy(*by).agg(
        F.count(error).alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        r2_column(a, p).alias("r2"),
    )


def key_mae(df: DataFrame, actual: str, predicted: str, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(F.abs(residual(actual, predicted))).alias("mae"))


def biggest_misses(
    df: DataFrame, actual: str, predicted: str, keys: Sequence[str], n: int = 10
) -> DataFrame:
    """The ``n`` rows with the largest absolute error, keys breaking ties."""
    scored = with_error(
        df.select(*keys, F.col(actual).alias("actual"), F.col(predicted).alias("predicted")),
        "actual",
        "predicted",
    )
    return scored.orderBy(F.abs("error").desc(), *keys).limit(n)


def comparison_table(metrics: DataFrame, places: int = 2) -> DataFrame:
    """Metric rows rounded for a report."""
    return metrics.withColumns({m: half_even(m, places) for m in ("mae", "rmse", "r2")})


def champion(metrics: DataFrame, order: str = "listed", by: Sequence[str] = ()) -> DataFrame:
    """The row with the highest r2; the one listed first wins a tie.

    ``metrics`` has a row per candidate and an ``order`` column with its place.
    """
    best = F.max_by(F.struct(*metrics.columns), F.struct(F.col("r2"), -F.col(order)))
    return metrics.groupBy(*by).agg(best.alias("_best")).select("_best.*")


def any_alert(
    df: DataFrame, value: str, keys: Sequence[str], level: float = HAZARD_LEVEL
) -> DataFrame:
    """Whether any row of a key is above the hazard level."""
    return df.groupBy(*keys).agg(F.bool_or(is_hazard(value, level)).alias("alert"))
