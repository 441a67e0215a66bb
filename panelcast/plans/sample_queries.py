"""Every operator as a query over the sample tables: ``(spark, folder) -> DataFrame``.

Doubles are rounded to six decimals here, and only here, so that two engines
that add in different order still give equal tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.functions import bands, calendar, derived, numbers
from panelcast.operators import clean, daily, metrics, profile, reshape, split, windows
from panelcast.plans import features, ingest, serve, views
from panelcast.session import fresh_folder
from panelcast.sources import sample
from panelcast.sources.store import PanelStore
from panelcast.spec import DAILY

H, W, P = sample.hourly_air, sample.hourly_weather, sample.daily_panel

AS_OF = dt.datetime(2024, 1, 30, 12)
BOUNDS = split.SplitBounds(
    None, dt.date(2000, 6, 30), dt.date(2000, 7, 1), dt.date(2001, 8, 1)
)
PANEL_AS_OF = dt.date(2001, 7, 20)


def rounded(df: DataFrame) -> DataFrame:
    return df.select(
        *(
            F.round(f.name, 6).alias(f.name) if isinstance(f.dataType, T.DoubleType) else f.name
            for f in df.schema
        )
    )


def panel(spark: SparkSession, sf: str) -> DataFrame:
    """Features and targets of P, incomplete rows included."""
    return features.daily_features(P(spark, sf))


def trainable(spark: SparkSession, sf: str) -> DataFrame:
    return features.training_rows(panel(spark, sf))


def persistence(spark: SparkSession, sf: str) -> DataFrame:
    """The test rows, tomorrow forecast as today."""
    _, test = split.event_time_split(trainable(spark, sf), BOUNDS)
    return test.select("city", "date", F.col("target_1d").alias("actual"), F.col("pm2_5").alias("predicted"))


BASELINE = {1: "pm2_5", 2: "pm25_rolling_3", 3: "pm25_rolling_7"}


def baseline_forecast(spark: SparkSession, sf: str) -> DataFrame:
    latest = features.latest_serving_rows(panel(spark, sf))
    return serve.forecast_rows(latest, BASELINE)


# --- time, joins, daily means -------------------------------------------------


def parse_time(spark, sf):
    text = P(spark, sf).select(
        "city", F.concat(calendar.label("date"), F.lit("T05:30")).alias("text")
    )
    time = calendar.parse_time("text")
    return text.select(
        "city", "text", time.alias("time"), calendar.day_of(time).alias("date"),
        calendar.hour_of_day(time).alias("hour"),
    )


def tag_and_union(spark, sf):
    hourly = clean.tagged(
        H(spark, sf).select("city", F.to_date("time").alias("date"), "pm2_5", "pm10"), feed="hourly"
    )
    days = clean.tagged(P(spark, sf).select("city", "date", "pm2_5", "humidity"), feed="daily")
    return rounded(reshape.union_frames([hourly, days]))


def hourly_join(spark, sf):
    return rounded(daily.join_feeds(H(spark, sf), W(spark, sf)))


def daily_mean(spark, sf):
    return rounded(daily.daily_mean(daily.join_feeds(H(spark, sf), W(spark, sf))))


def daily_mean_of_feeds(spark, sf):
    return rounded(daily.daily_mean_of_feeds(H(spark, sf), W(spark, sf)))


# --- windows ------------------------------------------------------------------


def panel_features(spark, sf):
    days = features.daily_panel(H(spark, sf), W(spark, sf))
    return rounded(features.training_rows(features.daily_features(days)))


def panel_features_gaps(spark, sf):
    return rounded(trainable(spark, sf))


def panel_features_chunked(spark, sf):
    return rounded(features.training_rows(features.daily_features(P(spark, sf), chunk="quarter")))


def panel_features_calendar(spark, sf):
    return rounded(features.training_rows(features.calendar_features(P(spark, sf))))


def series_features_hourly(spark, sf):
    return rounded(clean.complete(features.hourly_features(H(spark, sf), chunk="week")))


def derived_features(spark, sf):
    table = derived.with_derived(trainable(spark, sf))
    return rounded(table.select("city", "date", *derived.derived_columns()))


def latest_per_key(spark, sf):
    latest = windows.latest_rows(P(spark, sf), DAILY)
    ahead = calendar.days_after("date", 3)
    return rounded(
        latest.select(
            "city", "date", "pm2_5", ahead.alias("date_3d"),
            calendar.label("date").alias("iso"),
            calendar.label(ahead, calendar.SHORT_LABEL).alias("short"),
            calendar.label("date", calendar.LONG_LABEL).alias("long"),
        )
    )


# --- views, splits, folds -----------------------------------------------------


def onehot_keys(spark, sf):
    """Levels come from the training rows only."""
    train, test = split.event_time_split(P(spark, sf), BOUNDS)
    levels = reshape.key_levels(train, "city")
    return test.select(
        "city", "date", *(c.alias(_plain(n)) for n, c in reshape.one_hot("city", levels).items())
    )


def _plain(name: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in name).lower()


def feature_view(horizon: int):
    def run(spark, sf):
        return rounded(views.horizon_matrix(trainable(spark, sf), horizon))

    run.__name__ = f"feature_view_{horizon}d"
    return run


def time_split_counts(spark, sf):
    table = trainable(spark, sf)
    tag = split.split_tag(BOUNDS)
    return (
        table.withColumn("part", tag)
        .groupBy("part")
        .agg(F.count("*").alias("n"), F.min("date").alias("first"), F.max("date").alias("last"))
    )


def chronological_split(spark, sf):
    hourly = features.hourly_features(H(spark, sf))
    model = clean.complete(hourly, ["target_24h", "target_48h", "target_72h"])
    return (
        model.withColumn("part", split.chronological_tag(model, "time"))
        .groupBy("city", "part")
        .agg(F.count("*").alias("n"), F.min("time").alias("first"), F.max("time").alias("last"))
    )


def expanding_folds(spark, sf):
    table = P(spark, sf)
    folds = split.expanding_folds(table)
    return table.select("city", "date", split.fold_number(table, folds).cast("bigint").alias("fold"))


def asof_filter(spark, sf):
    compat = clean.observed_hours(H(spark, sf), AS_OF)
    strict = clean.observed_hours(H(spark, sf), AS_OF, strict=True)
    both = clean.tagged(compat, bound="day_end").unionByName(clean.tagged(strict, bound="moment"))
    return rounded(both.drop("pm10"))


def trailing_window(spark, sf):
    return rounded(clean.trailing_days(clean.up_to_day(P(spark, sf), PANEL_AS_OF)))


def trailing_window_per_key(spark, sf):
    upto = clean.up_to_day(P(spark, sf), PANEL_AS_OF)
    return rounded(clean.trailing_days(upto, keys=["city"]))


# --- profiles -----------------------------------------------------------------


def null_profile(spark, sf):
    return profile.null_counts(panel(spark, sf))


def column_profile(spark, sf):
    return profile.column_profile(panel(spark, sf))


def describe_target(spark, sf):
    return rounded(profile.describe(trainable(spark, sf), ["target_1d", "target_3d", "pm10"]))


def time_extent(spark, sf):
    return profile.time_extent(H(spark, sf), "time")


def key_inventory(spark, sf):
    return profile.key_inventory(P(spark, sf), "city").orderBy("city")


def drop_accounting(spark, sf):
    return profile.drop_accounting(panel(spark, sf), features.TRAINING_REQUIRES)


def table_shape(spark, sf):
    return profile.shape(panel(spark, sf))


def first_last_rows(spark, sf):
    table = P(spark, sf).select("city", "date", "pm2_5")
    first = clean.tagged(clean.first_rows(table, 10, ["city", "date"]), end="first")
    last = clean.tagged(clean.last_rows(table, 10, ["city", "date"]), end="last")
    return rounded(first.unionByName(last))


# --- keyed store and incremental refresh ---------------------------------------


def upsert_latest(spark, sf):
    table = P(spark, sf)
    store = PanelStore(spark, fresh_folder(spark, "store"))
    keyed = ingest.daily_table(store)
    keyed.upsert(table.where(F.col("date") <= F.lit(dt.date(2001, 6, 30))))
    late = table.where(F.col("date") >= F.lit(dt.date(2001, 6, 1)))
    keyed.upsert(late.withColumn("pm2_5", F.col("pm2_5") + 1.0))
    return rounded(store.read("daily_measures"))


def incremental_refresh(spark, sf):
    """All hours first, then a run that re-processes the last days."""
    air, weather = H(spark, sf), W(spark, sf)
    store = PanelStore(spark, fresh_folder(spark, "store"))
    keyed = ingest.daily_table(store)
    keyed.upsert(daily.daily_mean_of_feeds(air, weather))
    revised = air.withColumn("pm2_5", F.col("pm2_5") + 1.0)
    ingest.refresh(keyed, revised, weather, AS_OF)
    return rounded(keyed.read())


# --- forecast errors ----------------------------------------------------------


def persistence_metrics(spark, sf):
    return rounded(metrics.regression_metrics(persistence(spark, sf), "actual", "predicted"))


def persistence_key_mae(spark, sf):
    return rounded(metrics.key_mae(persistence(spark, sf), "actual", "predicted", "city"))


def biggest_misses(spark, sf):
    scored = persistence(spark, sf)
    return rounded(metrics.biggest_misses(scored, "actual", "predicted", ["city", "date"]))


PREDICTORS = ("pm25_lag_1", "pm25_rolling_3", "pm25_rolling_7")


def predictor_metrics(spark, sf) -> DataFrame:
    """r2 and the like of three plain predictors at each horizon."""
    _, test = split.event_time_split(trainable(spark, sf), BOUNDS)
    rows = F.array(
        *(
            F.struct(
                F.lit(h).cast("bigint").alias("horizon"),
                F.lit(i).cast("bigint").alias("listed"),
                F.lit(p).alias("model"),
                F.col(target).alias("actual"),
                F.col(p).alias("predicted"),
            )
            for h, target in derived.TARGETS.items()
            for i, p in enumerate(PREDICTORS)
        )
    )
    return metrics.regression_metrics(
        test.select(F.inline(rows)), "actual", "predicted", ["horizon", "listed", "model"]
    )


def champion(spark, sf):
    return rounded(metrics.champion(predictor_metrics(spark, sf), by=["horizon"]))


def comparison_table(spark, sf):
    return metrics.comparison_table(predictor_metrics(spark, sf))


def signed_change(spark, sf):
    trend = derived.derived_columns()["pm25_trend"]
    table = trainable(spark, sf).select("city", "date", trend.alias("pm25_trend"))
    return rounded(
        table.withColumns(
            {
                "direction": numbers.direction("pm25_trend"),
                "colour": numbers.direction_colour("pm25_trend"),
            }
        )
    )


def log_target(spark, sf):
    logged = P(spark, sf).select("city", "date", numbers.log_target("pm2_5").alias("log_pm2_5"))
    return rounded(logged.withColumn("pm2_5", numbers.from_log_target("log_pm2_5")))


# --- bands, alerts, serving tables -----------------------------------------------


def band_counts(spark, sf):
    table = P(spark, sf).select(
        bands.band_name("pm2_5").alias("category"),
        bands.band_colour("pm2_5").alias("colour"),
        bands.is_hazard("pm2_5").alias("hazard"),
        numbers.half_even("pm2_5").alias("whole"),
    )
    return table.groupBy("category", "colour", "hazard").agg(
        F.count("*").alias("n"), F.sum(F.col("whole").cast("bigint")).alias("whole_sum")
    )


def alerts(spark, sf):
    return metrics.any_alert(baseline_forecast(spark, sf), "prediction", ["city"])


def forecast_table(spark, sf):
    return rounded(
        baseline_forecast(spark, sf).withColumn("horizon", F.col("horizon").cast("bigint"))
    )


def key_comparison(spark, sf):
    return serve.comparison(features.latest_serving_rows(panel(spark, sf)), BASELINE)


def horizon_long(spark, sf):
    wide = key_comparison(spark, sf)
    labels = {"tomorrow": "Tomorrow", "in_2_days": "In 2 days", "in_3_days": "In 3 days"}
    return reshape.to_long(wide, ["city", "status"], labels, "horizon", "value")


def observed_plus_forecast(spark, sf):
    seen = clean.trailing_days(P(spark, sf))
    return rounded(reshape.observed_and_forecast(seen, baseline_forecast(spark, sf)))


def key_history(spark, sf):
    """One key's rows in order of time."""
    rows = clean.sorted_panel(clean.for_key(P(spark, sf), city="2-HIGH"), DAILY)
    return rounded(rows.select("city", "date", "pm2_5", "pm10"))


def display_labels(spark, sf):
    return serve.display_row(P(spark, sf))


QUERIES = {
    f.__name__: f
    for f in (
        parse_time, tag_and_union, hourly_join, daily_mean, daily_mean_of_feeds,
        panel_features, panel_features_gaps, panel_features_chunked, panel_features_calendar, series_features_hourly,
        derived_features, latest_per_key, onehot_keys,
        feature_view(1), feature_view(2), feature_view(3),
        time_split_counts, chronological_split, expanding_folds,
        asof_filter, trailing_window, trailing_window_per_key,
        null_profile, column_profile, describe_target, time_extent, key_inventory,
        drop_accounting, table_shape, first_last_rows,
        upsert_latest, incremental_refresh,
        persistence_metrics, persistence_key_mae, biggest_misses, champion, comparison_table,
        signed_change, log_target, band_counts, alerts, forecast_table, key_comparison,
        horizon_long, observed_plus_forecast, display_labels, key_history,
    )
}
