"""Train, compare, pick and register a model per horizon."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.derived import TARGETS, feature_names, with_derived
from panelcast.models.fit import Fitted, fit, fit_linear, fit_log_forest, forest
from panelcast.models.registry import ModelRegistry
from panelcast.models.search import FOLDS, expanding_search
from panelcast.models.together import together
from panelcast.operators import metrics, profile
from panelcast.operators.reshape import union_frames
from panelcast.operators.split import SplitBounds, event_time_split
from panelcast.plans.views import horizon_matrix
from panelcast.session import saved

# Which model families are searched per horizon, besides the linear model.
SEARCHED = {1: ("forest",), 2: ("forest", "boosted"), 3: ("forest", "boosted")}

# Settings of the forest sweep (fixed values).
SWEEP = (
    {"trees": 100, "depth": None},
    {"trees": 200, "depth": 10},
    {"trees": 200, "depth": 20},
)


def model_name(horizon: int) -> str:
    return f"panel_model_{horizon}d"


def evaluate(fitted: Iterable[Fitted], test: DataFrame, label: str) -> DataFrame:
    """``(listed, model, n, mae, rmse, r2)``, a row per model, from one scan of the
    test rows: every model scores the same row."""
    fitted = list(fitted)
    scored = test
    for i, f in enumerate(fitted):
        scored = f.score(scored, f"_p{i}")
    rows = F.array(
        *(
            F.struct(
                F.lit(i).cast("bigint").alias("listed"),
                F.lit(f.name).alias("model"),
                F.col(label).alias("actual"),
                F.col(f"_p{i}").alias("predicted"),
            )
            for i, f in enumerate(fitted)
        )
    )
    return metrics.regression_metrics(
        scored.select(F.inline(rows)), "actual", "predicted", ["listed", "model"]
    )


@dataclass(frozen=True)
class ErrorAnalysis:
    key_mae: DataFrame
    target: DataFrame
    misses: DataFrame


def error_analysis(
    fitted: Fitted, train: DataFrame, test: DataFrame, label: str, keys: Sequence[str] = ("city",)
) -> ErrorAnalysis:
    """What one model gets wrong on the test rows, which are scored once and saved."""
    scored = saved(fitted.score(test).select(*keys, "date", label, "prediction"), "scored")
    return ErrorAnalysis(
        metrics.key_mae(scored, label, "prediction", *keys),
        profile.describe(train, [label]),
        metrics.biggest_misses(scored, label, "prediction", [*keys, "date"]),
    )


@dataclass(frozen=True)
class Training:
    horizon: int
    candidates: list[Fitted]
    metrics: DataFrame
    champion: Fitted
    champion_metrics: dict[str, float]
    searches: dict[str, DataFrame]
    errors: ErrorAnalysis
    log_forest: DataFrame | None


def train_horizon(
    table: DataFrame,
    horizon: int,
    bounds: SplitBounds,
    grids: Mapping[str, Mapping[str, Sequence[Any]]] | None = None,
    folds: int = FOLDS,
    log_params: Mapping[str, Any] | None = None,
    families: Sequence[str] | None = None,
    report: str | None = None,
) -> Training:
    """Fit the linear model and the searched families, and pick the best by test r2.

    ``grids`` replaces a family's full grid. With ``log_params`` the log-target
    forest is scored too; it is a diagnostic and never a candidate. ``report`` names the
    candidate whose errors are analysed, by default the champion.
    """
    label = TARGETS[horizon]
    train, test = event_time_split(horizon_matrix(table, horizon), bounds)
    train, test = train.persist(), test.persist()
    try:
        candidates, searches = [fit_linear(train, horizon)], {}
        for family in SEARCHED[horizon] if families is None else families:
            grid = None if grids is None else grids.get(family)
            result = expanding_search(
                train, family, feature_names(horizon), label, grid=grid, folds=folds, gap=horizon
            )
            candidates.append(result.best)
            searches[family] = result.scores
        # A row per candidate: a handful, and the reports below are reused.
        scores = evaluate(candidates, test, label).collect()
        spark = table.sparkSession
        schema = "listed bigint, model string, n bigint, mae double, rmse double, r2 double"
        score_table = spark.createDataFrame(scores, schema)
        best = metrics.champion(score_table).first()
        log_scores = None
        if log_params is not None:
            log_model = fit_log_forest(train, horizon, **log_params)
            rows = evaluate([log_model], test, label).collect()
            log_scores = spark.createDataFrame(rows, schema)
        champion = candidates[best.listed]
        reported = champion if report is None else next(c for c in candidates if c.name == report)
        errors = error_analysis(reported, train, test, label)
    finally:
        train.unpersist()
        test.unpersist()
    return Training(
        horizon,
        candidates,
        score_table,
        champion,
        {m: best[m] for m in ("mae", "rmse", "r2")},
        searches,
        errors,
        log_scores,
    )


def register(training: Training, registry: ModelRegistry) -> int:
    return registry.register(
        model_name(training.horizon),
        training.champion,
        training.champion_metrics,
        f"{training.champion.name} forecasting {training.horizon} day(s) ahead",
    )


def load_models(
    registry: ModelRegistry,
    horizons: Sequence[int] = tuple(TARGETS),
    version: int | str = "latest",
) -> dict[int, Fitted]:
    return {h: registry.load(model_name(h), version) for h in horizons}


def score_horizons(latest: DataFrame, models: Mapping[int, Fitted]) -> DataFrame:
    """The rows with a ``prediction_<h>d`` column per model, all in one job.

    The derived features of every horizon are added once; each model reads its
    own.
    """
    scored = with_derived(latest)
    for horizon, fitted in models.items():
        scored = fitted.score(scored, f"prediction_{horizon}d")
    return scored


def prediction_columns(models: Mapping[int, Fitted]) -> dict[int, str]:
    return {h: f"prediction_{h}d" for h in models}


def param_sweep(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    label: str,
    key: str | None = "city",
    settings: Sequence[Mapping[str, Any]] = SWEEP,
    time: str = "date",
    gap: int = 1,
) -> DataFrame:
    """Rounded scores of a forest under each named setting. ``gap``: rows until a label is known."""
    train = train.persist()
    try:
        fitted = together(
            train.sparkSession,
            lambda s: fit(train, forest(**s), features, label, str(dict(s)), key, time=time, gap=gap),
            settings,
        )
    finally:
        train.unpersist()
    return metrics.comparison_table(evaluate(fitted, test, label))


def horizon_comparison(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    labels: Mapping[str, str],
    key: str | None = "city",
    time: str = "date",
    gaps: Mapping[str, int] | None = None,
    **params: Any,
) -> DataFrame:
    """One forest per label, compared: ``labels`` maps a horizon's name to its column, ``gaps`` to the rows
    until its label is known."""
    train = train.persist()

    def scores(item: tuple[str, str]) -> DataFrame:
        name, label = item
        gap = 1 if gaps is None else gaps[name]
        fitted = fit(train, forest(**params), features, label, name, key, time=time, gap=gap)
        return evaluate([fitted], test, label).withColumnRenamed("model", "horizon").drop("listed")

    try:
        tables = together(train.sparkSession, scores, labels.items())
    finally:
        train.unpersist()
    return metrics.comparison_table(union_frames(tables))
