"""Regressors and how to fit them on a feature table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.derived import TARGETS, feature_names
from panelcast.functions.numbers import log_target
from panelcast.models.absorb import AbsorbedLinear, fit_absorbed
from panelcast.models.leafwise import fit_trees
from panelcast.models.levels import LEVEL, Levelled, stored_levels, with_running_levels
from panelcast.models.matrix import FEATURES, linear_feature_names, matrix_stages, spread
from panelcast.session import saved

SEED = 42
# Spark's own limit, standing in for "no depth limit".
DEEPEST = 30
# Boosted trees without a depth limit: the usual leaf cap of 31 fits depth 5.
BOOSTED_DEPTH = 5
LOG_LABEL = "_log_label"


def linear() -> LinearRegression:
    """Ordinary least squares. Up to 4096 features Spark solves the normal
    equations, which takes one pass over the rows."""
    return LinearRegression(featuresCol=FEATURES, regParam=0.0, solver="auto")


def forest(
    trees: int = 100, depth: int | None = None, leaf: int = 1, seed: int = SEED, resample: bool = True
) -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol=FEATURES,
        numTrees=trees,
        maxDepth=DEEPEST if depth is None else depth,
        minInstancesPerNode=leaf,
        featureSubsetStrategy="all",
        maxMemoryInMB=512,
        bootstrap=resample,
        seed=seed,
    )


def boosted(
    iterations: int = 150, depth: int | None = None, rate: float = 0.1, seed: int = SEED
) -> GBTRegressor:
    return GBTRegressor(
        featuresCol=FEATURES,
        maxIter=iterations,
        maxDepth=BOOSTED_DEPTH if depth is None else depth,
        stepSize=rate,
        maxBins=255,
        seed=seed,
    )


@dataclass(frozen=True)
class Fitted:
    """A pipeline with the raw columns it reads."""

    name: str
    model: PipelineModel
    features: tuple[str, ...]
    key: str | None = "city"
    params: dict[str, Any] = field(default_factory=dict)

    form = "pipeline"

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(path)

    def score(self, df: DataFrame, prediction: str = "prediction") -> DataFrame:
        """``df`` with one more column; its rows and columns stay as they are."""
        scored = self.model.transform(df)
        return scored.select(*df.columns, F.col("prediction").alias(prediction))


def fit(
    train: DataFrame,
    estimator: Estimator,
    features: Sequence[str],
    label: str,
    name: str = "model",
    key: str | None = "city",
    log: bool = False,
    time: str = "date",
    gap: int = 1,
) -> Fitted | Levelled:
    """Fit on rows whose label is known. ``log`` fits log1p of the label and
    returns predictions on the label's own scale.

    Trees read the key as its level (see ``levels``), learned from labels that are ``gap`` rows older; a
    linear model, and trees on rows without a time, get a place for each key."""
    levelled = key is not None and not isinstance(estimator, LinearRegression) and time in train.columns
    if levelled:
        train = saved(with_running_levels(train, label, key, time, gap), "levelled")
        stages = matrix_stages([*features, LEVEL], None)
    else:
        stages = matrix_stages(features, key)
    if not isinstance(estimator, LinearRegression):
        read = [LEVEL] if levelled else [key] if key else []
        rows = spread(train, [*features, *read, label])
    else:
        rows = train
    if log:
        rows = rows.withColumn(LOG_LABEL, log_target(label))
        estimator = estimator.copy(
            {estimator.labelCol: LOG_LABEL, estimator.predictionCol: "_log_prediction"}
        )
        back = SQLTransformer(
            statement="SELECT *, expm1(_log_prediction) AS prediction FROM __THIS__"
        )
        stages = [*stages, estimator, back]
    else:
        stages = [*stages, estimator.copy({estimator.labelCol: label})]
    model = Pipeline(stages=stages).fit(rows)
    if levelled:
        return Levelled(name, model, tuple(features), key, stored_levels(train, label, key))
    return Fitted(name, model, tuple(features), key)


def fit_linear(train: DataFrame, horizon: int, key: str | None = "city") -> Fitted | AbsorbedLinear:
    """Least squares of a horizon's target with an effect per key.

    Key effects are absorbed, however many keys there are; rows without a key
    share an effect of their own.
    """
    names, label = linear_feature_names(horizon), TARGETS[horizon]
    if key is None:
        return fit(train, linear(), names, label, "linear", None)
    return fit_absorbed(train, names, label, key)


def fit_forest(train: DataFrame, horizon: int, key: str | None = "city", **params) -> Fitted | Levelled:
    return fit(train, forest(**params), feature_names(horizon), TARGETS[horizon], "forest", key, gap=horizon)


def fit_boosted(train: DataFrame, horizon: int, key: str | None = "city", **params) -> Fitted | Levelled:
    return fit(train, boosted(**params), feature_names(horizon), TARGETS[horizon], "boosted", key, gap=horizon)


def fit_leafwise(train: DataFrame, horizon: int, key: str | None = "city", **params) -> Fitted | Levelled:
    """Boosted trees grown best first (see ``leafwise``)."""
    names, label = feature_names(horizon), TARGETS[horizon]
    if key is None:
        return Fitted("leafwise", fit_trees(train, names, label, **params), tuple(names), None)
    rows = saved(with_running_levels(train, label, key, gap=horizon), "levelled")
    model = fit_trees(rows, [*names, LEVEL], label, **params)
    return Levelled("leafwise", model, tuple(names), key, stored_levels(rows, label, key))


def fit_log_forest(
    train: DataFrame,
    horizon: int,
    key: str | None = "city",
    trees: int = 400,
    depth: int = 8,
    leaf: int = 3,
) -> Fitted | Levelled:
    estimator = forest(trees, depth, leaf)
    return fit(
        train, estimator, feature_names(horizon), TARGETS[horizon], "log_forest", key, log=True, gap=horizon
    )
