"""Joining hourly feeds and averaging them to days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.spec import AIR_MEASURES, WEATHER_MEASURES


def _names(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def join_feeds(air: DataFrame, weather: DataFrame, on: Sequence[str] = ("city", "time")) -> DataFrame:
    """Hours present in both feeds, all keys at once. NULL keys never match."""
    return air.join(weather, list(on), "inner")


def daily_mean(
    hourly: DataFrame,
    measures: Sequence[str] = (*AIR_MEASURES, *WEATHER_MEASURES),
    key: str | Sequence[str] = "city",
    time: str = "time",
) -> DataFrame:
    """Mean per key and day over the hours that have a value, and the hour count.

    ``n_obs`` shows a day that is still filling up.
    """
    return hourly.groupBy(*_names(key), F.to_date(time).alias("date")).agg(
        *(F.avg(m).alias(m) for m in measures), F.count(F.lit(1)).alias("n_obs")
    )


def daily_mean_of_feeds(
    air: DataFrame,
    weather: DataFrame,
    air_measures: Sequence[str] = AIR_MEASURES,
    weather_measures: Sequence[str] = WEATHER_MEASURES,
    key: str | Sequence[str] = "city",
    time: str = "time",
) -> DataFrame:
    """``daily_mean(join_feeds(air, weather))`` without joining copies.

    Each feed is first reduced to sums and counts per key and hour, so an hour
    delivered many times over joins as a single row and no task ever holds its
    copies. In the joined mean a row of one feed counts once for every copy in
    the other, hence the weights.
    """

    keys = _names(key)

    def reduced(feed: DataFrame, measures: Sequence[str], rows: str) -> DataFrame:
        return feed.groupBy(*keys, time).agg(
            *(F.sum(m).alias(f"{m}_sum") for m in measures),
            *(F.count(m).alias(f"{m}_n") for m in measures),
            F.count(F.lit(1)).alias(rows),
        )

    joined = reduced(air, air_measures, "_air").join(
        reduced(weather, weather_measures, "_weather"), [*keys, time], "inner"
    )

    def mean(measure: str, copies: str):
        total = F.sum(F.col(f"{measure}_sum") * F.col(copies))
        return F.try_divide(total, F.sum(F.col(f"{measure}_n") * F.col(copies))).alias(measure)

    return joined.groupBy(*keys, F.to_date(time).alias("date")).agg(
        *(mean(m, "_weather") for m in air_measures),
        *(mean(m, "_air") for m in weather_measures),
        F.sum(F.col("_air") * F.col("_weather")).alias("n_obs"),
    )
