"""What a forecast reader sees: dated forecasts, bands, alerts, comparison, labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.bands import band_colour, band_name, is_hazard
from panelcast.functions.calendar import ISO_LABEL, LONG_LABEL, SHORT_LABEL, days_after, label
from panelcast.functions.numbers import half_even, tenths_text, whole_text


def forecast_rows(
    wide: DataFrame,
    predictions: Mapping[int, str],
    keys: Sequence[str] = ("city",),
    date: str = "date",
    missing_is_top: bool = False,
) -> DataFrame:
    """``(keys, as_of_date, horizon, target_date, label, prediction, category, colour, alert)``.

    ``predictions`` maps a horizon in days to the column that forecasts it.
    """
    steps = F.array(
        *(
            F.struct(F.lit(h).alias("horizon"), F.col(c).cast("double").alias("prediction"))
            for h, c in predictions.items()
        )
    )
    long = wide.select(*keys, F.col(date).alias("as_of_date"), F.inline(steps))
    target = days_after("as_of_date", F.col("horizon"))
    return long.select(
        *keys,
        "as_of_date",
        "horizon",
        target.alias("target_date"),
        label(target, SHORT_LABEL).alias("label"),
        "prediction",
        band_name("prediction", missing_is_top=missing_is_top).alias("category"),
        band_colour("prediction", missing_is_top=missing_is_top).alias("colour"),
        is_hazard("prediction").alias("alert"),
    )


def comparison(
    wide: DataFrame, predictions: Mapping[int, str], keys: Sequence[str] = ("city",)
) -> DataFrame:
    """Whole-number forecasts side by side and the band of the first one."""
    names = {1: "tomorrow", 2: "in_2_days", 3: "in_3_days"}
    return wide.select(
        *keys,
        *(half_even(c).cast("bigint").alias(names[h]) for h, c in predictions.items()),
        band_name(predictions[1]).alias("status"),
    )


def display_row(latest: DataFrame, keys: Sequence[str] = ("city",), date: str = "date") -> DataFrame:
    """The texts shown for the last observed day of each key."""
    return latest.select(
        *keys,
        label(date, ISO_LABEL).alias("as_of"),
        label(date, LONG_LABEL).alias("today"),
        whole_text("pm2_5").alias("pm2_5"),
        band_name("pm2_5").alias("category"),
        tenths_text("temperature").alias("temperature"),
        whole_text("humidity").alias("humidity"),
        tenths_text("wind_speed").alias("wind_speed"),
        whole_text("pressure").alias("pressure"),
    )
