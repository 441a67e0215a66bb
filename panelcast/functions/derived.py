"""Features that need only columns of the same row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INPUTS = (
    "pm2_5", "pm10", "temperature", "humidity", "wind_speed", "pressure",
    "day_of_week", "month",
    "pm25_lag_1", "pm25_lag_3", "pm25_lag_7", "pm25_rolling_3", "pm25_rolling_7",
)

TARGETS = {1: "target_1d", 2: "target_2d", 3: "target_3d"}


def derived_columns() -> dict[str, Column]:
    """Name -> expression. Dividing by zero gives NULL, never an error."""
    lag1, lag3, lag7, mean7 = (
        F.col(c) for c in ("pm25_lag_1", "pm25_lag_3", "pm25_lag_7", "pm25_rolling_7")
    )
    return {
        "aqi_change_rate": (lag1 - lag3) / F.lit(3.0),
        "volatility_7": F.abs(lag1 - mean7),
        "wind_stagnation": F.try_divide(F.col("humidity"), F.col("wind_speed") + F.lit(1.0)),
        "pressure_humidity": F.col("pressure") * F.col("humidity") / F.lit(1000.0),
        "pm25_trend": lag1 - lag7,
        "pm25_rolling_max_7": F.greatest(lag1, lag3, lag7, mean7),
    }


# Derived features each horizon's model uses on top of the inputs.
DERIVED_BY_HORIZON = {
    1: ("aqi_change_rate",),
    2: (
        "aqi_change_rate", "volatility_7", "wind_stagnation",
        "pressure_humidity", "pm25_trend", "pm25_rolling_max_7",
    ),
    3: ("aqi_change_rate", "volatility_7", "wind_stagnation", "pressure_humidity"),
}


def feature_names(horizon: int) -> list[str]:
    return [*INPUTS, *DERIVED_BY_HORIZON[horizon]]


def with_derived(df: DataFrame, horizon: int | None = None) -> DataFrame:
    """Add one horizon's derived features, or all of them (what serving needs)."""
    columns = derived_columns()
    wanted = columns if horizon is None else DERIVED_BY_HORIZON[horizon]
    return df.withColumns({name: columns[name] for name in wanted})
