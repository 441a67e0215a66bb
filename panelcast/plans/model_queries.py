"""Model operators as queries over the sample panel, with small models."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.derived import TARGETS, with_derived
from panelcast.models import explain, levels, search
from panelcast.models.absorb import fit_absorbed
from panelcast.models.fit import boosted, fit, fit_boosted, fit_forest, fit_leafwise, fit_linear, fit_log_forest, forest
from panelcast.models.leafwise import fit_trees
from panelcast.models.matrix import linear_feature_names
from panelcast.models.registry import ModelRegistry
from panelcast.models.statistics import LinearStatistics
from panelcast.models.together import together
from panelcast.operators import clean, metrics, split
from panelcast.operators.reshape import union_frames
from panelcast.plans import features, forecast, ingest, serve, train
from panelcast.plans.sample_queries import BOUNDS, PANEL_AS_OF, H, P, panel, rounded
from panelcast.plans.views import horizon_matrix
from panelcast.session import fresh_folder, saved
from panelcast.sources.sample import table
from panelcast.sources.store import PanelStore

SMALL_FOREST = {"trees": 20, "depth": 5, "leaf": 3}
SMALL_BOOSTED = {"iterations": 10, "depth": 4, "rate": 0.1}
SMALL_LEAFWISE = {"iterations": 4, "leaves": 8}
SMALL_GRIDS = {
    "forest": {"depth": [3, 4], "leaf": [3], "trees": [5]},
    "boosted": {"rate": [0.1], "depth": [3], "iterations": [3]},
}

HOURLY_FEATURES = (
    "pm10", "hour", "day_of_week", "month",
    "pm25_lag_1", "pm25_lag_24", "pm25_rolling_3", "pm25_rolling_24",
)
HOURLY_TARGETS = {"24h": "target_24h", "48h": "target_48h", "72h": "target_72h"}
HOURLY_GAPS = {"24h": 24, "48h": 48, "72h": 72}


def _stored(spark, sf) -> DataFrame:
    """The feature table, computed once and stored: every fit, score and
    background below reads the table instead of computing its features again."""
    return saved(panel(spark, sf), "features")


def _parts(table: DataFrame, horizon: int) -> tuple[DataFrame, DataFrame]:
    matrix = horizon_matrix(features.training_rows(table), horizon)
    return split.event_time_split(matrix, BOUNDS)


def _forecast(spark, sf, fit_one) -> DataFrame:
    table = _stored(spark, sf)
    fitted = together(spark, lambda h: fit_one(_parts(table, h)[0], h), TARGETS)
    models = dict(zip(TARGETS, fitted, strict=True))
    wide = train.score_horizons(features.latest_serving_rows(table), models)
    return serve.forecast_rows(wide, train.prediction_columns(models))


def linear_forecast(spark, sf):
    rows = _forecast(spark, sf, fit_linear)
    return rows.select(
        "city", "as_of_date", F.col("horizon").cast("bigint").alias("horizon"), "target_date",
        F.round("prediction", 4).alias("prediction"), "category", "alert",
    )


def linear_from_statistics(spark, sf):
    """The forecasts of ``linear_forecast`` from stored moments, brought up to date in two steps."""
    table = _stored(spark, sf)
    store = PanelStore(spark, fresh_folder(spark, "store"))

    kept = {h: LinearStatistics.in_store(store, f"moments_{h}d", linear_feature_names(h), TARGETS[h]) for h in TARGETS}

    def fit_one(horizon: int):
        rows, _ = _parts(table, horizon)
        for span in (F.col("date") < F.lit(dt.date(2000, 1, 1)), F.col("date") >= F.lit(dt.date(2000, 1, 1))):
            kept[horizon].update(rows.where(span))
        return kept[horizon].fit()

    models = dict(zip(TARGETS, together(spark, fit_one, TARGETS), strict=True))
    rows = serve.forecast_rows(train.score_horizons(features.latest_serving_rows(table), models), train.prediction_columns(models))
    return rows.select(
        "city", "as_of_date", F.col("horizon").cast("bigint").alias("horizon"), "target_date",
        F.round("prediction", 4).alias("prediction"), "category", "alert",
    )


def linear_metrics(spark, sf):
    stored = _stored(spark, sf)

    def scores(horizon: int) -> DataFrame:
        rows, test = _parts(stored, horizon)
        table = train.evaluate([fit_linear(rows, horizon)], test, TARGETS[horizon])
        return table.withColumn("horizon", F.lit(horizon).cast("bigint"))

    table = union_frames(together(spark, scores, TARGETS))
    return table.select(
        "horizon", "model", "n", *(F.round(m, 5).alias(m) for m in ("mae", "rmse", "r2"))
    )


def linear_many_keys(spark, sf):
    """Least squares with an effect per part, and one for the rows whose part is unknown."""
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_partkey") % 7 != 0, F.col("l_partkey")).alias("part"),
        *(F.col(c).cast("double").alias(c) for c in ("l_quantity", "l_discount", "l_extendedprice")),
    )
    fitted = fit_absorbed(rows, ["l_quantity", "l_discount"], "l_extendedprice", "part")
    scored = fitted.score(rows)
    return scored.select("l_orderkey", "l_linenumber", F.round("prediction", 3).alias("prediction"))


def forest_forecast(spark, sf):
    return rounded(_forecast(spark, sf, lambda rows, h: fit_forest(rows, h, **SMALL_FOREST)))


def boosted_forecast(spark, sf):
    return rounded(_forecast(spark, sf, lambda rows, h: fit_boosted(rows, h, **SMALL_BOOSTED)))


def log_forest(spark, sf):
    rows, test = _parts(_stored(spark, sf), 2)
    fitted = fit_log_forest(rows, 2, **SMALL_FOREST)
    return rounded(train.evaluate([fitted], test, TARGETS[2]))


def stump_forecasts(spark, sf):
    """Trees of one split on two features with few values: these can be checked split by split."""
    rows, test = _parts(_stored(spark, sf), 1)
    names, label = ("day_of_week", "month"), TARGETS[1]
    tree = forest(trees=1, depth=1, resample=False)
    models = (
        fit(rows, tree, names, label, "forest", key=None),
        fit(rows, tree, names, label, "log_forest", key=None, log=True),
        fit(rows, boosted(iterations=2, depth=1), names, label, "boosted", key=None),
    )
    for model in models:
        test = model.score(test, model.name)
    return test.select("city", "date", *(F.round(m.name, 4).alias(m.name) for m in models))


def boosted_leafwise(spark, sf):
    """Two boosted trees of three leaves, grown best first, on two features with few values."""
    rows, test = _parts(_stored(spark, sf), 1)
    model = fit_trees(rows, ("day_of_week", "month"), TARGETS[1], iterations=2, leaves=3, scale=2.0**20)
    return model.transform(test).select("city", "date", F.round("prediction", 6).alias("prediction"))


def leafwise_forecast(spark, sf):
    """Boosted trees grown best first, for every horizon, keys by their levels."""
    return rounded(_forecast(spark, sf, lambda rows, h: fit_leafwise(rows, h, **SMALL_LEAFWISE)))


def key_levels(spark, sf):
    """Every training row's key level, and the key's last one, at each horizon."""
    table = _stored(spark, sf)

    def found(horizon: int) -> DataFrame:
        rows, _ = _parts(table, horizon)
        last = levels.last_levels(rows, TARGETS[horizon]).withColumnRenamed(levels.LEVEL, "last")
        running = levels.with_running_levels(rows, TARGETS[horizon], gap=horizon)
        return running.join(last, F.col("city") == F.col("_k")).select(
            F.lit(horizon).cast("bigint").alias("horizon"), "city", "date",
            F.round(levels.LEVEL, 6).alias("level"), F.round("last", 6).alias("last_level"),
        )

    return union_frames([found(h) for h in TARGETS])


def stump_attribution(spark, sf):
    """Exact impacts of two boosted stumps on the newest rows, against the last 15 days of all keys."""
    table = _stored(spark, sf)
    rows, _ = _parts(table, 1)
    fitted = fit(rows, boosted(iterations=2, depth=1), ("day_of_week", "month"), TARGETS[1], "boosted", key=None)
    latest = features.latest_serving_rows(table)
    recent = clean.trailing_days(features.serving_rows(table))
    impacts = explain.tree_attribution(latest, fitted, recent)
    return impacts.select("city", "date", "feature", F.round("impact", 4).alias("impact"))


def _background(table: DataFrame) -> DataFrame:
    return explain.background_sample(
        with_derived(clean.trailing_days(features.serving_rows(table)))
    )


def linear_attribution(spark, sf):
    table = _stored(spark, sf)
    impacts = explain.linear_attribution(
        with_derived(features.latest_serving_rows(table)),
        fit_linear(_parts(table, 2)[0], 2),
        _background(table),
        features=("aqi_change_rate", "pm25_trend"),
    )
    return rounded(explain.top_impacts(impacts))


def linear_impacts(spark, sf):
    """What moved each key's forecast, at every horizon, against the last 15 days of all keys."""
    table = _stored(spark, sf)
    latest = with_derived(features.latest_serving_rows(table))
    recent = with_derived(clean.trailing_days(features.serving_rows(table)))

    def impacts(horizon: int) -> DataFrame:
        fitted = fit_linear(_parts(table, horizon)[0], horizon)
        found = explain.linear_attribution(latest, fitted, recent)
        return found.withColumn("horizon", F.lit(horizon).cast("bigint"))

    rows = union_frames(together(spark, impacts, TARGETS))
    return rows.select("horizon", "city", "date", "feature", F.round("impact", 4).alias("impact"))


def top_linear_impacts(spark, sf):
    """The ten strongest impacts on tomorrow's forecast of each key."""
    table = _stored(spark, sf)
    recent = with_derived(clean.trailing_days(features.serving_rows(table)))
    impacts = explain.linear_attribution(
        with_derived(features.latest_serving_rows(table)), fit_linear(_parts(table, 1)[0], 1), recent
    )
    return explain.top_impacts(impacts.withColumn("impact", F.round("impact", 4)))


def background_rows(spark, sf):
    """The seeded sample of recent rows that attributions compare with."""
    return _background(_stored(spark, sf)).select("city", "date")


def linear_errors(spark, sf):
    """The error report of tomorrow's linear model: by key, the training target, the worst days."""
    trained = train.train_horizon(
        features.training_rows(_stored(spark, sf)), 1, BOUNDS, families=(), report="linear"
    )
    none = F.lit(None)
    by_key = trained.errors.key_mae.select(
        F.lit("mae").alias("part"), "city", none.cast("date").alias("date"), F.col("mae").alias("value")
    )
    stats = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    target = trained.errors.target.unpivot([], stats, "part", "value").select(
        "part", none.cast("string").alias("city"), none.cast("date").alias("date"), "value"
    )
    worst = trained.errors.misses.select(F.lit("miss").alias("part"), "city", "date", F.col("error").alias("value"))
    return union_frames([by_key, target, worst]).withColumn("value", F.round("value", 4))


def registered_linear(spark, sf):
    """Linear models through search, registry and serving: the same forecasts as ``linear_forecast``."""
    store = PanelStore(spark, fresh_folder(spark, "store"))
    ingest.daily_table(store).upsert(P(spark, sf))
    table = ingest.refresh_features(store)
    registry = ModelRegistry(spark, fresh_folder(spark, "models"))
    labelled = features.training_rows(table.read())
    for done in together(
        spark, lambda h: train.train_horizon(labelled, h, BOUNDS, families=()), TARGETS
    ):
        train.register(done, registry)
    last = table.last_day()
    rows = forecast.forecast(table, train.load_models(registry), last, (last - dt.date(1990, 1, 1)).days)
    return rows.select(
        "city", "as_of_date", F.col("horizon").cast("bigint").alias("horizon"), "target_date",
        F.round("prediction", 4).alias("prediction"), "category", "alert",
    )


def shapley_gaps(spark, sf):
    """Per key, a forest's forecast less the background's mean and all impacts: nothing is left, as the
    orders are sampled but every order's steps add up."""
    table = _stored(spark, sf)
    latest = with_derived(features.latest_serving_rows(table))
    others = _background(table)
    fitted = fit_forest(_parts(table, 3)[0], 3, **SMALL_FOREST)
    impacts = explain.shapley_attribution(latest, fitted, others).groupBy("city").agg(
        F.count("*").alias("features"), F.sum("impact").alias("moved")
    )
    centre = fitted.score(others).agg(F.avg("prediction")).first()[0]
    gap = F.col("prediction") - F.lit(centre) - F.col("moved")
    rows = fitted.score(latest).select("city", "prediction").join(impacts, "city")
    return rows.select("city", "features", F.round(F.abs(gap), 6).alias("gap"))


def forest_attribution(spark, sf):
    table = _stored(spark, sf)
    impacts = explain.tree_attribution(
        with_derived(features.latest_serving_rows(table)),
        fit_forest(_parts(table, 3)[0], 3, **SMALL_FOREST),
        _background(table),
    )
    return rounded(explain.top_impacts(impacts))


def registered_forecast(spark, sf):
    """Daily table, feature table, search, pick, register, load and serve."""
    store = PanelStore(spark, fresh_folder(spark, "store"))
    ingest.daily_table(store).upsert(P(spark, sf))
    table = ingest.refresh_features(store)
    registry = ModelRegistry(spark, fresh_folder(spark, "models"))
    labelled = features.training_rows(table.read())
    trained = together(
        spark, lambda h: train.train_horizon(labelled, h, BOUNDS, SMALL_GRIDS, folds=2), TARGETS
    )
    for done in trained:
        train.register(done, registry)
    return rounded(forecast.forecast(table, train.load_models(registry), PANEL_AS_OF))


def model_comparison(spark, sf):
    """Every family on the same test rows, the champion marked."""
    rows, test = _parts(_stored(spark, sf), 2)
    rows = rows.persist()
    fitted = [
        fit_linear(rows, 2),
        fit_forest(rows, 2, **SMALL_FOREST),
        fit_boosted(rows, 2, **SMALL_BOOSTED),
    ]
    rows.unpersist()
    scores = train.evaluate(fitted, test, TARGETS[2])
    best = metrics.champion(scores).select("listed", F.lit(True).alias("champion"))
    return rounded(scores.join(best, "listed", "left").fillna(False, ["champion"]))


def _hourly_parts(spark, sf) -> tuple[DataFrame, DataFrame]:
    path = fresh_folder(spark, "features")
    clean.complete(features.hourly_features(H(spark, sf))).select(
        "city", "time",
        *(F.col(c).cast("double").alias(c) for c in HOURLY_FEATURES),
        *HOURLY_TARGETS.values(),
    ).write.parquet(path)
    table = spark.read.parquet(path)
    tag = split.chronological_tag(table, "time")
    return table.where(tag == "train"), table.where(tag == "test")


def horizon_comparison(spark, sf):
    rows, test = _hourly_parts(spark, sf)
    return train.horizon_comparison(
        rows, test, HOURLY_FEATURES, HOURLY_TARGETS, time="time", gaps=HOURLY_GAPS, **SMALL_FOREST
    )


def param_sweep(spark, sf):
    rows, test = _hourly_parts(spark, sf)
    settings = ({"trees": 10, "depth": 4}, {"trees": 20, "depth": 4}, {"trees": 20, "depth": 6})
    return train.param_sweep(
        rows, test, HOURLY_FEATURES, HOURLY_TARGETS["24h"], settings=settings, time="time", gap=24
    )


def stump_search(spark, sf):
    """A search whose trees can be checked: stumps, and stumps stopped at their root, over the folds of the training rows."""
    rows, _ = _parts(_stored(spark, sf), 1)
    grid = {"depth": [0, 1], "leaf": [1], "trees": [1], "resample": [False]}
    found = search.expanding_search(rows, "forest", ("day_of_week", "month"), TARGETS[1], None, grid)
    return found.scores.select("place", "fold", F.round("r2", 6).alias("r2"))


def stump_sweep(spark, sf):
    """Tomorrow's hour by the mean and by a stump, as a comparison of settings."""
    rows, test = _hourly_parts(spark, sf)
    settings = tuple({"trees": 1, "depth": d, "resample": False} for d in (0, 1))
    table = train.param_sweep(rows, test, ("hour", "day_of_week"), HOURLY_TARGETS["24h"], None, settings)
    return table.select("listed", "n", "mae", "rmse", "r2")


def stump_horizons(spark, sf):
    """One stump for each hourly horizon, compared."""
    rows, test = _hourly_parts(spark, sf)
    table = train.horizon_comparison(
        rows, test, ("hour", "day_of_week"), HOURLY_TARGETS, None, trees=1, depth=1, resample=False
    )
    return table.select("horizon", "n", "mae", "rmse", "r2")


QUERIES = {
    f.__name__: f
    for f in (
        linear_forecast, linear_metrics, linear_many_keys, forest_forecast, boosted_forecast, log_forest,
        linear_attribution, forest_attribution, registered_forecast, model_comparison,
        horizon_comparison, param_sweep, linear_impacts, linear_errors, registered_linear, shapley_gaps,
        stump_forecasts, boosted_leafwise, leafwise_forecast, key_levels, stump_attribution,
        top_linear_impacts, background_rows, linear_from_statistics, stump_search, stump_sweep, stump_horizons,
    )
}
