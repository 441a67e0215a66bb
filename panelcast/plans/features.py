"""From feeds to feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from panelcast.functions.calendar import day_of_week, hour_of_day, month_of_year
from panelcast.operators.clean import complete, gap_filled
from panelcast.operators.daily import daily_mean_of_feeds
from panelcast.operators.windows import (
    DAILY_RECIPE,
    HOURLY_RECIPE,
    WindowRecipe,
    latest_rows,
    with_windows,
)
from panelcast.spec import DAILY, HOURLY_AIR, PanelSpec

# Columns a daily row needs before it may be trained on (fixed values).
TRAINING_REQUIRES = ("target_1d", "target_2d", "target_3d", "pm25_lag_7", "pm25_rolling_7")
SERVING_REQUIRES = ("pm25_lag_7", "pm25_rolling_7")


def daily_panel(air: DataFrame, weather: DataFrame) -> DataFrame:
    return daily_mean_of_feeds(air, weather)


def daily_features(
    daily: DataFrame,
    spec: PanelSpec = DAILY,
    recipe: WindowRecipe = DAILY_RECIPE,
    chunk: str | None = None,
) -> DataFrame:
    """Calendar parts, lags, trailing means and targets, incomplete rows included."""
    dated = daily.withColumns(
        {"day_of_week": day_of_week(spec.time), "month": month_of_year(spec.time)}
    )
    return with_windows(dated, spec, recipe, chunk)


def calendar_features(
    daily: DataFrame, spec: PanelSpec = DAILY, recipe: WindowRecipe = DAILY_RECIPE
) -> DataFrame:
    """``daily_features`` whose windows count days: a window that reaches a missing day is NULL."""
    days = daily_features(gap_filled(daily, spec), spec, recipe)
    return days.where("not _filled").drop("_filled")


def training_rows(features: DataFrame) -> DataFrame:
    """Rows with all labels and a full history."""
    return complete(features, TRAINING_REQUIRES)


def serving_rows(features: DataFrame, labelled_only: bool = False) -> DataFrame:
    """Rows with a full history; the newest ones have no label yet.

    ``labelled_only`` keeps to training rows, whose last date is three rows old.
    """
    return training_rows(features) if labelled_only else complete(features, SERVING_REQUIRES)


def latest_serving_rows(
    features: DataFrame, spec: PanelSpec = DAILY, labelled_only: bool = False
) -> DataFrame:
    return latest_rows(serving_rows(features, labelled_only), spec)


def hourly_features(
    hourly: DataFrame,
    spec: PanelSpec = HOURLY_AIR,
    recipe: WindowRecipe = HOURLY_RECIPE,
    chunk: str | None = "month",
) -> DataFrame:
    """The hourly variant: windows include the current hour, targets are a day apart.

    Hourly series are long, so their windows run in time chunks.
    """
    timed = hourly.withColumns(
        {
            "hour": hour_of_day(spec.time),
            "day_of_week": day_of_week(spec.time),
            "month": month_of_year(spec.time),
        }
    )
    return with_windows(timed, spec, recipe, chunk)
