"""How much each feature moved a forecast away from a background's mean forecast."""

from __future__ import annotations

import json
import math
import random
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.functions.numbers import direction, direction_colour
from panelcast.models.absorb import AbsorbedLinear
from panelcast.models.fit import Fitted
from panelcast.models.levels import LEVEL, Levelled
from panelcast.models.matrix import LINEAR_RELATIONS
from panelcast.models.trees import leaf_paths
from panelcast.operators.clean import sample_rows
from panelcast.session import saved

BACKGROUND_ROWS = 20
TOP_IMPACTS = 10
MAX_BACKGROUND = 1000


def background_sample(
    rows: DataFrame, keys: Sequence[str] = ("city", "date"), n: int = BACKGROUND_ROWS, seed: int = 42
) -> DataFrame:
    return sample_rows(rows, n, keys, seed)


def minimum_norm(
    weights: Mapping[str, float], relations: Mapping[str, Mapping[str, float]]
) -> dict[str, float]:
    """Spread weights over features that are combinations of the others.

    Any multiple of ``combination - feature`` may be added to the weights
    without changing a forecast. The least-squares solver convention is the
    shortest such weight vector.
    """
    names = [*weights, *(r for r in relations if r not in weights)]
    vector = np.array([weights.get(n, 0.0) for n in names])
    free = np.array(
        [
            [combination.get(n, 0.0) - float(n == feature) for n in names]
            for feature, combination in relations.items()
        ]
    ).reshape(len(relations), len(names))
    if len(free):
        vector = vector - free.T @ np.linalg.solve(free @ free.T, free @ vector)
    return dict(zip(names, vector.tolist(), strict=True))


def linear_weights(
    fitted: Fitted | AbsorbedLinear, features: Sequence[str] | None = None
) -> dict[str, float]:
    """Weight per feature of a linear pipeline, the key left out.

    ``features`` may add features the model left out as redundant; they get the
    share the minimum-norm solution gives them.
    """
    if isinstance(fitted, AbsorbedLinear):
        own = fitted.weights
    else:
        own = fitted.model.stages[-1].coefficients.toArray()[: len(fitted.features)].tolist()
    weights = dict(zip(fitted.features, own, strict=True))
    added = {
        f: LINEAR_RELATIONS[f] for f in features or () if f in LINEAR_RELATIONS and f not in weights
    }
    return minimum_norm(weights, added)


def linear_attribution(
    rows: DataFrame,
    fitted: Fitted | AbsorbedLinear,
    background: DataFrame,
    keys: Sequence[str] = ("city", "date"),
    features: Sequence[str] | None = None,
) -> DataFrame:
    """Exact attributions ``(keys, feature, impact)`` of a linear model.

    A feature's impact is its weight times its distance from the background
    mean. The key's impact is whatever else moved the forecast: its level effect.
    """
    weights = linear_weights(fitted, features)
    centre = (
        fitted.score(background, "_prediction")
        .agg(F.avg("_prediction").alias("_prediction"), *(F.avg(f).alias(f) for f in weights))
        .first()
    )
    scored = fitted.score(rows, "_prediction")
    impacts = {
        f: F.lit(w) * (F.col(f).cast("double") - F.lit(centre[f])) for f, w in weights.items()
    }
    if fitted.key is not None:
        explained = sum(impacts.values(), F.lit(0.0))
        impacts[fitted.key] = F.col("_prediction") - F.lit(centre["_prediction"]) - explained
    return scored.select(
        *keys,
        F.inline(
            F.array(
                *(F.struct(F.lit(f).alias("feature"), i.alias("impact")) for f, i in impacts.items())
            )
        ),
    )


def _inputs(fitted: Fitted | Levelled, df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df`` with the columns a tree model reads, and their names; the key's level stands for the key."""
    names = list(fitted.features)
    if isinstance(fitted, Levelled):
        df = df.join(fitted.levels, df[fitted.key] == fitted.levels["_k"], "left").drop("_k").fillna(0.0, [LEVEL])
        names.append(LEVEL)
    return df, names


def _mask(path: str, values: str) -> Column:
    """A bit for each feature of a path whose interval admits the row's value."""
    bits = F.transform(path, lambda p, i: F.when(
        (F.get(values, p["feature"]) > p["low"]) & (F.get(values, p["feature"]) <= p["high"]),
        F.call_function("shiftleft", F.lit(1).cast("bigint"), i),
    ).otherwise(F.lit(0).cast("bigint")))
    return F.aggregate(bits, F.lit(0).cast("bigint"), lambda a, b: a + b)


def tree_attribution(
    rows: DataFrame,
    fitted: Fitted | Levelled,
    background: DataFrame,
    keys: Sequence[str] = ("city", "date"),
) -> DataFrame:
    """Exact Shapley attributions ``(keys, feature, impact)`` of a forest or boosted model.

    A leaf is a table row: its value, and an interval for each feature on its way. Let a row switch features from a
    background row's values to its own. The leaf is reached by just those switches that hold the p features only the
    row's values satisfy and none of the q that only the background's satisfy, so its value is worth
    ``(p-1)! q! / (p+q)!`` of itself to each of the p and minus ``p! (q-1)! / (p+q)!`` to each of the q, summed over
    all orders in closed form. Summed over leaves and averaged over the background, nothing is sampled, and a row's impacts add
    up to its forecast less the background's mean forecast.

    Background rows that satisfy the same part of a path are one. The background has ``MAX_BACKGROUND`` rows at most (more raise); the
    leaves are the fitted model's, met by every row to explain; credits are summed before they move.
    """
    if not 0 < background.limit(MAX_BACKGROUND + 1).count() <= MAX_BACKGROUND:
        raise ValueError(f"the background must have 1 to {MAX_BACKGROUND} rows")
    model = next(s for s in fitted.model.stages if hasattr(s, "trees"))
    mine, names = _inputs(fitted, rows)
    others, _ = _inputs(fitted, background)
    vector = F.array(*(F.col(n).cast("double") for n in names))
    leaves = leaf_paths(rows.sparkSession, model)
    seen = leaves.join(others.select(vector.alias("z"))).select("tree", "leaf", "gain", "path", _mask("path", "z").alias("mask"))
    seen = seen.groupBy("tree", "leaf", "gain", "path", "mask").agg(F.count("*").alias("n"))
    seen = seen.groupBy("tree", "leaf", "gain", "path").agg(F.collect_list(F.struct("mask", "n")).alias("others"))
    n_others = F.aggregate("others", F.lit(0).cast("bigint"), lambda a, o: a + o["n"])
    leaves = saved(seen.withColumn("share", F.col("gain") / n_others).drop("gain"), "leaf-intervals")

    parallel = rows.sparkSession.sparkContext.defaultParallelism
    mine = mine.select(F.struct(*keys).alias("_id"), vector.alias("x")).repartition(parallel, "_id")
    met = mine.join(leaves).select("_id", "path", "share", "others", _mask("path", "x").alias("own"))
    full = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.size("path")) - 1
    met = met.select("_id", "path", "share", "own", full.alias("full"), F.inline("others"))
    met = met.where(F.col("own").bitwiseOR(F.col("mask")) == F.col("full"))
    only = F.col("own").bitwiseAND(F.bitwise_not("mask"))
    theirs = F.col("mask").bitwiseAND(F.bitwise_not("own"))
    met = met.select("_id", "path", (F.col("share") * F.col("n")).alias("worth"), only.alias("only"), theirs.alias("theirs"), F.bit_count(only).alias("p"), F.bit_count(theirs).alias("q"))
    most = len(names)
    part = [math.factorial(max(0, p - 1)) * math.factorial(q) / math.factorial(p + q) if p else 0.0 for p in range(most + 1) for q in range(most + 1)]
    table = F.array(*(F.lit(v) for v in part))
    weight = lambda p, q: F.get(table, p * (most + 1) + q)
    on = lambda mask, i: F.call_function("shiftright", mask, i).bitwiseAND(F.lit(1)) == 1
    p, q = F.col("p"), F.col("q")
    credit = F.transform("path", lambda s, i: F.struct(
        s["feature"].alias("player"),
        F.when(on(F.col("only"), i), F.col("worth") * weight(p, q)).when(on(F.col("theirs"), i), -F.col("worth") * weight(q, p)).otherwise(0.0).alias("credit"),
    ))
    credits = met.select("_id", F.inline(credit)).groupBy("_id", "player").agg(F.sum("credit").alias("impact"))
    shown = F.array(*(F.lit(fitted.key if n == LEVEL else n) for n in names))
    # features on no way moved nothing
    every = mine.select("_id", F.explode(F.sequence(F.lit(0), F.lit(len(names) - 1))).alias("player"))
    joined = every.join(credits, ["_id", "player"], "left")
    return joined.select("_id.*", F.get(shown, F.col("player")).alias("feature"), F.coalesce("impact", F.lit(0.0)).alias("impact"))


def _orders(players: int, pairs: int, seed: int) -> list[list[int]]:
    """Seeded orders, each with its reverse, which cancels much of the noise."""
    generator = random.Random(seed)
    orders = []
    for _ in range(pairs):
        order = generator.sample(range(players), players)
        orders += [order, order[::-1]]
    return orders


def shapley_attribution(
    rows: DataFrame,
    fitted: Fitted | AbsorbedLinear,
    background: DataFrame,
    keys: Sequence[str] = ("city", "date"),
    pairs: int = 4,
    seed: int = 42,
) -> DataFrame:
    """Sampled Shapley attributions ``(keys, feature, impact)`` of any model.

    For every background row and every order the features are switched one by
    one from the background's value to the row's, and each switch's change in
    the forecast is credited to its feature. The impacts of a row add up exactly
    to its forecast minus the background's mean forecast.

    Everything is one map over the rows: the background (``MAX_BACKGROUND`` rows at most,
    a larger one raises) and the orders are small constants, and credits are summed before anything is shuffled.
    """
    players = [*fitted.features, *([fitted.key] if fitted.key else [])]
    types = {f.name: f.dataType for f in background.schema}
    shape = T.StructType([T.StructField(p, types[p]) for p in players])
    sample = [r.asDict() for r in background.select(*players).limit(MAX_BACKGROUND + 1).collect()]
    if not 0 < len(sample) <= MAX_BACKGROUND:
        raise ValueError(f"the background must have 1 to {MAX_BACKGROUND} rows")
    orders = _orders(len(players), pairs, seed)
    places = [sorted(range(len(players)), key=order.__getitem__) for order in orders]

    def constant(value: object, schema: T.DataType):
        return F.from_json(F.lit(json.dumps(value)), schema)

    numbers = T.ArrayType(T.IntegerType())
    order_type = T.StructType([T.StructField("order", numbers), T.StructField("place", numbers)])
    both = [{"order": o, "place": p} for o, p in zip(orders, places, strict=True)]
    steps = len(players)

    # Rows to explain are few and small, the work per row is large: spread them.
    parallel = rows.sparkSession.sparkContext.defaultParallelism
    spread = rows.select(
        F.struct(*keys).alias("_id"), F.struct(*(F.col(p) for p in players)).alias("_row")
    ).repartition(parallel, "_id")
    mixed = (
        spread.withColumn("_other", F.explode(constant(sample, T.ArrayType(shape))))
        .withColumn("_way", F.explode(constant(both, T.ArrayType(order_type))))
        .withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(steps))))
        .select(
            "_id",
            "_way.order",
            "_step",
            *(
                F.when(F.col("_way.place")[i] < F.col("_step"), F.col(f"_row.`{p}`"))
                .otherwise(F.col(f"_other.`{p}`"))
                .alias(p)
                for i, p in enumerate(players)
            ),
        )
    )
    forecast = F.col("_forecast")
    credits = F.array(
        F.struct(
            F.get("order", F.col("_step") - 1).alias("player"), forecast.alias("credit")
        ),
        F.struct(F.get("order", F.col("_step")).alias("player"), (-forecast).alias("credit")),
    )
    names = F.array(*(F.lit(p) for p in players))
    return (
        fitted.score(mixed, "_forecast")
        .select("_id", F.inline(credits))
        .where(F.col("player").isNotNull())
        .groupBy("_id", "player")
        .agg((F.sum("credit") / F.lit(float(len(sample) * len(orders)))).alias("impact"))
        .select("_id.*", F.get(names, F.col("player")).alias("feature"), "impact")
    )


def top_impacts(
    attribution: DataFrame, keys: Sequence[str] = ("city", "date"), n: int = TOP_IMPACTS
) -> DataFrame:
    """Each row's strongest features, weakest of them first in ``place``."""
    strongest = Window.partitionBy(*keys).orderBy(F.abs("impact").desc(), F.col("feature"))
    ranked = attribution.withColumn("_rank", F.row_number().over(strongest)).where(
        F.col("_rank") <= n
    )
    return ranked.select(
        *keys,
        (F.lit(n + 1) - F.col("_rank")).alias("place"),
        "feature",
        "impact",
        direction("impact").alias("direction"),
        direction_colour("impact").alias("colour"),
    )
