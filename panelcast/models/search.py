"""Grid search over growing-window folds, with few fits.

Spark's own cross validation trains on everything outside a fold, later rows
included. Here fold ``i`` trains only on rows before it.

One fit answers for many combinations: a forest's first trees are a smaller forest, a boosted model's first trees
are the model after fewer iterations, and a forest's trees stopped at a depth are trees grown to that depth. So
only the largest ensemble of each remaining setting is fitted per fold, and walked through once (``trees.cut_predictions``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from itertools import product
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.models.fit import DEEPEST, Fitted, boosted, forest
from panelcast.models.levels import LEVEL, Levelled, stored_levels, with_running_levels
from panelcast.models.matrix import FEATURES, matrix_stages, spread
from panelcast.models.together import together
from panelcast.models.trees import cut_predictions
from panelcast.operators.metrics import r2_column
from panelcast.operators.split import expanding_folds, fold_number
from panelcast.session import saved

# Full grids (fixed values).
FOREST_GRID = {"depth": [8, 12, None], "leaf": [1, 3, 5], "trees": [200, 400]}
BOOSTED_GRID = {"rate": [0.05, 0.1], "depth": [4, 6, None], "iterations": [150, 300]}
FOLDS = 3

FAMILIES: dict[str, tuple[Callable[..., Estimator], Mapping[str, Sequence[Any]]]] = {
    "forest": (forest, FOREST_GRID),
    "boosted": (boosted, BOOSTED_GRID),
}
# The setting that counts a family's trees, and whether its trees may be stopped at a depth.
COUNTED = {"forest": "trees", "boosted": "iterations"}
STOPPED = {"forest": True, "boosted": False}


def combinations(grid: Mapping[str, Sequence[Any]]) -> list[dict[str, Any]]:
    return [dict(zip(grid, values, strict=True)) for values in product(*grid.values())]


@dataclass(frozen=True)
class SharedFit:
    """The settings of one fit, and the combinations it answers for: place in the grid, place in ``depths``, trees."""

    settings: dict[str, Any]
    depths: list[int | None]
    answers: list[tuple[int, int, int]]


@dataclass(frozen=True)
class Told:
    """A smaller ensemble whose predictions are a column already."""

    column: str

    def transform(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("prediction", F.col(self.column))


def _score(model: Told, rows: DataFrame, label: str) -> float | None:
    return model.transform(rows).agg(r2_column(F.col(label), F.col("prediction"))).first()[0]


def shared_fits(family: str, tries: Sequence[Mapping[str, Any]]) -> list[SharedFit]:
    """The fewest fits that answer for all combinations."""
    count, stopped = COUNTED[family], STOPPED[family]
    groups: dict[tuple, list[int]] = {}
    for place, one in enumerate(tries):
        fixed = {k: v for k, v in one.items() if k != count and not (stopped and k == "depth")}
        groups.setdefault(tuple(sorted(fixed.items(), key=str)), []).append(place)
    out = []
    for fixed, places in groups.items():
        trees = [tries[p].get(count) for p in places]
        settings = dict(fixed) | ({count: max(trees)} if trees[0] is not None else {})
        depths: list[int | None] = [None]
        if stopped and "depth" in tries[places[0]]:
            depths = list(dict.fromkeys(tries[p]["depth"] for p in places))
            settings["depth"] = max((DEEPEST if d is None else d) for d in depths)
        at = {d: i for i, d in enumerate(depths)}
        out.append(SharedFit(settings, depths, [(p, at.get(tries[p].get("depth"), 0), n) for p, n in zip(places, trees, strict=True)]))
    return out


@dataclass(frozen=True)
class SearchResult:
    best: Fitted | Levelled
    scores: DataFrame
    """``(place, params, fold, r2)``, a row per combination and fold."""


def expanding_search(
    train: DataFrame,
    family: str,
    features: Sequence[str],
    label: str,
    key: str | None = "city",
    grid: Mapping[str, Sequence[Any]] | None = None,
    folds: int = FOLDS,
    parallelism: int = 4,
    time: str = "date",
    gap: int = 1,
) -> SearchResult:
    """Score every combination by mean r2 over the folds and refit the best.

    The vectors are assembled once and kept by the executors; fits run a few at
    a time, each a distributed job of its own. The first combination wins ties. A key enters as the level
    it had on the row's day, so a fold knows no later label.
    """
    make, full_grid = FAMILIES[family]
    tries = combinations(full_grid if grid is None else grid)
    names = list(features)
    if key is not None:
        train = saved(with_running_levels(train, label, key, time, gap), "levelled")
        names.append(LEVEL)
    matrix = Pipeline(stages=matrix_stages(names, None)).fit(train)
    plan = expanding_folds(train, time, folds)
    assembled = (
        matrix.transform(spread(train, [*names, label, time]))
        .withColumn("_fold", fold_number(train, plan, time))
        .select(FEATURES, label, "_fold")
        .persist()
    )
    spark = train.sparkSession
    shared = shared_fits(family, tries)

    def run(fit: SharedFit, fold: int) -> list[tuple[int, int, float | None]]:
        estimator = make(**fit.settings)
        model = estimator.copy({estimator.labelCol: label}).fit(assembled.where(F.col("_fold") < fold))
        counts = sorted({n or model.getNumTrees for _, _, n in fit.answers})
        walked = cut_predictions(model, assembled.where(F.col("_fold") == fold), fit.depths, counts, [label, "_fold"])
        told = saved(walked, "fold-predictions")
        columns = [(place, f"p{depth}_{n or model.getNumTrees}") for place, depth, n in fit.answers]
        return [(place, fold, _score(Told(column), told, label)) for place, column in columns]

    try:
        jobs = [(fit, fold) for fit in shared for fold in plan.numbers]
        found = {(p, f): s for rows in together(spark, lambda job: run(*job), jobs, parallelism) for p, f, s in rows}
        rows = [(p, str(tries[p]), f, found[p, f]) for p in range(len(tries)) for f in plan.numbers]
        means = [
            sum(r[3] if r[3] is not None else float("-inf") for r in rows if r[0] == place) / folds
            for place in range(len(tries))
        ]
        best = tries[means.index(max(means))]
        estimator = make(**best)
        model = estimator.copy({estimator.labelCol: label}).fit(assembled)
    finally:
        assembled.unpersist()
    whole = PipelineModel([*matrix.stages, model])
    scores = spark.createDataFrame(rows, "place int, params string, fold int, r2 double")
    if key is None:
        return SearchResult(Fitted(family, whole, tuple(features), None, best), scores)
    return SearchResult(Levelled(family, whole, tuple(features), key, stored_levels(train, label, key), best), scores)
