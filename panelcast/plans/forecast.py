"""The serving run: recent features, loaded models, one table of forecasts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame

from panelcast.models.fit import Fitted
from panelcast.operators.windows import latest_rows
from panelcast.plans.serve import comparison, forecast_rows
from panelcast.plans.train import prediction_columns, score_horizons
from panelcast.sources.store import KeyedTable
from panelcast.spec import DAILY

# Days before the last one that serving looks at (fixed value).
RECENT_DAYS = 15


def scored_latest(
    table: KeyedTable, models: Mapping[int, Fitted], as_of: dt.date, days: int = RECENT_DAYS
) -> DataFrame:
    """The latest row of every key seen lately, with a prediction per horizon.

    Only the months of the last ``days`` days are read, and all keys are scored
    in one job.
    """
    recent = table.trailing(days, until=as_of)
    return score_horizons(latest_rows(recent, DAILY), models)


def forecast(
    table: KeyedTable, models: Mapping[int, Fitted], as_of: dt.date, days: int = RECENT_DAYS
) -> DataFrame:
    """A row per key and horizon with date, band, colour and alert."""
    scored = scored_latest(table, models, as_of, days)
    return forecast_rows(scored, prediction_columns(models))


def compare_keys(
    table: KeyedTable, models: Mapping[int, Fitted], as_of: dt.date, days: int = RECENT_DAYS
) -> DataFrame:
    return comparison(scored_latest(table, models, as_of, days), prediction_columns(models))
