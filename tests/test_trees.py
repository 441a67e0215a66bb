"""Trees grown, cut, walked and explained, against plain computations."""

import datetime as dt
import heapq
import itertools
import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from panelcast.models import explain, leafwise, levels, search, trees
from panelcast.models.fit import DEEPEST, boosted, fit, forest
from panelcast.models.registry import ModelRegistry
from panelcast.session import fresh_folder, saved

NAMES = ["a", "b", "c", "d", "e", "f"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = np.c_[rng.integers(0, 7, (500, 3)), rng.normal(size=(500, 3)).round(1)]
    y = x[:, 0] * 3 - (x[:, 1] > 3) * x[:, 4] * 9 + x[:, 2] * (x[:, 3] > 0) + rng.normal(size=500)
    data = [(i, "xyz"[i % 3], dt.date(2024, 1, 1) + dt.timedelta(days=i // 3), *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))]
    schema = "id int, city string, date date, " + ", ".join(f"{n} double" for n in NAMES) + ", y double"
    return saved(spark.createDataFrame(data, schema), "rows")


# --- best-first growth ----------------------------------------------------------


def plain_tree(bins, g, leaves, smallest, deepest):
    """A tree grown one leaf at a time, every histogram counted anew: (leaf of each row, leaf sums)."""

    def best(own):
        top = None
        total, n = int(g[own].sum()), len(own)
        for f, k in itertools.product(range(bins.shape[1]), range(int(bins.max()))):
            low = own[bins[own, f] <= k]
            if smallest <= len(low) <= n - smallest:
                a, b = float(g[low].sum()), float(total - g[low].sum())
                gain = a * a / len(low) + b * b / (n - len(low)) - float(total) * float(total) / n
                if gain > 0 and (top is None or gain > top[0]):
                    top = (gain, f, k)
        return top

    made, done = 0, []
    queue = []

    def put(own, depth):
        nonlocal made
        split = best(own) if depth < deepest else None
        if split:
            heapq.heappush(queue, (-split[0], made, own, split, depth))
        else:
            done.append(own)
        made += 1

    put(np.arange(len(g)), 0)
    while queue and len(queue) + len(done) < leaves:
        _, _, own, (_, f, k), depth = heapq.heappop(queue)
        put(own[bins[own, f] <= k], depth + 1)
        put(own[bins[own, f] > k], depth + 1)
    return done + [own for _, _, own, _, _ in queue]


@pytest.mark.parametrize(("leaves", "smallest", "depth"), [(3, 20, None), (12, 5, None), (31, 1, 4), (6, 300, None)])
def test_boosting_by_plain_growth(rows, leaves, smallest, depth):
    iterations, rate, scale = 3, 0.3, 2.0**20
    model = leafwise.fit_trees(rows, NAMES, "y", iterations, rate, leaves, smallest, depth, bins=20, scale=scale)
    got = {r.id: r.prediction for r in model.transform(rows).collect()}
    table = rows.orderBy("id").toPandas()
    cuts = leafwise.edges(rows, NAMES, 20)
    bins = np.stack([np.searchsorted(np.array(c), table[n], "left") for n, c in zip(NAMES, cuts, strict=True)], axis=1)
    whole = np.floor(table["y"] * scale + 0.5).astype(np.int64).to_numpy()
    base = math.floor(int(whole.sum()) / len(whole) + 0.5)
    rest, told = whole - base, np.full(len(whole), base)
    for _ in range(iterations):
        for own in plain_tree(bins, rest, leaves, smallest, math.inf if depth is None else depth):
            value = math.floor(rate * float(rest[own].sum()) / len(own) + 0.5)
            rest[own] -= value
            told[own] += value
    assert [got[i] for i in range(len(whole))] == pytest.approx((told / scale).tolist(), abs=1e-9)


def test_bins_are_quantiles_of_wide_features(spark):
    wide = spark.range(5000).select((F.col("id") * 1.0).alias("v"), (F.col("id") % 3 * 1.0).alias("w"), F.lit(1.0).alias("u"))
    v, w, u = leafwise.edges(wide, ["v", "w", "u"], 50)
    assert (w, u) == ([0.0, 1.0], []) and 45 <= len(v) <= 49 and max(v) < 4999
    counts = wide.groupBy(leafwise.binned(wide, ["v"], [v])[0].alias("k")).count().collect()
    assert len(counts) == len(v) + 1 and max(r["count"] for r in counts) < 250


def test_leafwise_does_not_depend_on_the_order_of_rows(rows):
    sums = {
        round(leafwise.fit_trees(r, NAMES, "y", 2, leaves=6).transform(rows).agg(F.sum("prediction")).first()[0], 9)
        for r in (rows, rows.repartition(7), rows.orderBy(F.desc("y")))
    }
    assert len(sums) == 1


def test_leafwise_model_is_saved_and_loaded(spark, rows):
    model = leafwise.fit_trees(rows, NAMES, "y", 2, leaves=4)
    levelled = levels.Levelled("leafwise", model, tuple(NAMES), "city", levels.stored_levels(rows, "y", "city"))
    registry = ModelRegistry(spark, fresh_folder(spark, "models"))
    registry.register("m", levelled, {"r2": 1.0})
    loaded = registry.load("m")
    assert loaded.form == "levelled" and loaded.features == tuple(NAMES)
    gap = levelled.score(rows, "p").join(loaded.score(rows, "q").select("id", "q"), "id").agg(F.max(F.abs(F.col("p") - F.col("q")))).first()[0]
    assert gap == 0


# --- trees cut short -------------------------------------------------------------


def vectors(rows):
    return VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows)


def test_cut_trees_are_trees_grown_to_the_depth(rows):
    """A forest without a depth limit, stopped at a depth, is the forest of that depth."""
    ready = vectors(rows)
    deep = forest(trees=6, depth=None, leaf=2)
    model = deep.copy({deep.labelCol: "y"}).fit(ready)
    told = trees.cut_predictions(model, ready, [1, 3, None], [6], ["id"]).collect()
    for place, depth in enumerate((1, 3, DEEPEST)):
        small = forest(trees=6, depth=depth, leaf=2)
        own = {r.id: r.prediction for r in small.copy({small.labelCol: "y"}).fit(ready).transform(ready).collect()}
        assert {r.id: r[f"p{place}_6"] for r in told} == pytest.approx(own)


def test_first_trees_are_a_smaller_ensemble(rows):
    ready = vectors(rows)
    most = boosted(iterations=7, depth=2)
    model = most.copy({most.labelCol: "y"}).fit(ready)
    told = trees.cut_predictions(model, ready, [None], [3, 7], ["id"]).collect()
    less = boosted(iterations=3, depth=2)
    own = {r.id: r.prediction for r in less.copy({less.labelCol: "y"}).fit(ready).transform(ready).collect()}
    assert {r.id: r.p0_3 for r in told} == pytest.approx(own)
    assert {r.id: r.p0_7 for r in told} == pytest.approx({r.id: r.prediction for r in model.transform(ready).collect()})


def test_full_grids_need_few_fits():
    found = search.shared_fits("forest", search.combinations(search.FOREST_GRID))
    assert [f.settings for f in found] == [{"leaf": n, "trees": 400, "depth": DEEPEST} for n in (1, 3, 5)]
    assert sorted(a[0] for f in found for a in f.answers) == list(range(18))
    found = search.shared_fits("boosted", search.combinations(search.BOOSTED_GRID))
    assert len(found) == 6 and all(f.settings["iterations"] == 300 and f.depths == [None] for f in found)


def test_search_scores_each_combination_as_its_own_fit(rows):
    """Shared fits score a combination as a fit of its own does, where the trees are the same."""
    grid = {"depth": [2, None], "leaf": [5], "trees": [4]}
    shared = search.expanding_search(rows, "forest", NAMES, "y", None, grid, folds=2).scores.collect()
    alone = [
        r for one in ([2], [None]) for r in search.expanding_search(rows, "forest", NAMES, "y", None, grid | {"depth": one}, folds=2).scores.collect()
    ]
    assert {(r.params, r.fold): r.r2 for r in shared} == pytest.approx({(r.params, r.fold): r.r2 for r in alone})


# --- exact attributions ----------------------------------------------------------


@pytest.mark.parametrize("family", ["forest", "boosted"])
def test_tree_attribution_against_all_orders(spark, rows, family):
    estimator = forest(trees=3, depth=5, leaf=2) if family == "forest" else boosted(iterations=3, depth=3)
    fitted = fit(rows, estimator, NAMES, "y", key=None)
    some, others = rows.where("id in (3, 77)"), rows.where("id in (1, 40, 200, 201)")
    found = {(r.id, r.feature): r.impact for r in explain.tree_attribution(some, fitted, others, ["id"]).collect()}
    # the value of every set of switched features
    xs, zs = some.collect(), others.collect()
    mixes = [(x.id, z.id, s, *(x[n] if s >> i & 1 else z[n] for i, n in enumerate(NAMES))) for x in xs for z in zs for s in range(64)]
    table = spark.createDataFrame(mixes, "x int, z int, s int, " + ", ".join(f"{n} double" for n in NAMES))
    value = {(r.x, r.s): r.v for r in fitted.score(table, "p").groupBy("x", "s").agg(F.avg("p").alias("v")).collect()}
    for x in xs:
        for i, n in enumerate(NAMES):
            total = 0.0
            for order in itertools.permutations(range(6)):
                before = sum(1 << k for k in order[: order.index(i)])
                total += value[x.id, before | 1 << i] - value[x.id, before]
            assert found[x.id, n] == pytest.approx(total / math.factorial(6), abs=1e-9)


def test_key_gets_its_own_impact(rows):
    fitted = fit_leafwise_small(rows)
    some, others = rows.limit(5), rows.where("id % 50 = 0")
    impacts = explain.tree_attribution(some, fitted, others, ["id"])
    assert {r.feature for r in impacts.select("feature").distinct().collect()} == {*NAMES, "city"}
    base = fitted.score(others).agg(F.avg("prediction")).first()[0]
    moved = {r.id: r.m for r in impacts.groupBy("id").agg(F.sum("impact").alias("m")).collect()}
    assert {r.id: r.prediction - base for r in fitted.score(some).collect()} == pytest.approx(moved)


def fit_leafwise_small(rows):
    train = levels.with_running_levels(rows, "y")
    model = leafwise.fit_trees(train, [*NAMES, levels.LEVEL], "y", 3, leaves=6, smallest=5)
    return levels.Levelled("leafwise", model, tuple(NAMES), "city", levels.stored_levels(rows, "y", "city"))


# --- key levels ------------------------------------------------------------------


def test_levels_by_hand(spark):
    day = lambda n: dt.date(2024, 1, n)
    table = spark.createDataFrame(
        [("a", day(1), 1.0), ("a", day(2), 3.0), ("a", day(4), 5.0), ("b", day(2), 10.0), ("b", day(4), None), (None, day(2), 99.0)],
        "city string, date date, y double",
    )
    found = {(r.city, r.date.day): r[levels.LEVEL] for r in levels.with_running_levels(table, "y").collect()}
    # day 2 knows a's 1; day 4 knows a's 1 and 3, b's 10: all keys' mean is 14 / 3
    assert found[("a", 1)] == found[("b", 2)] == found[(None, 2)] == 0
    assert found[("a", 2)] == pytest.approx(0.0)
    assert found[("a", 4)] == pytest.approx((4 - 2 * 14 / 3) / 3) and found[("b", 4)] == pytest.approx((10 - 14 / 3) / 2)
    last = {r["_k"]: r[levels.LEVEL] for r in levels.last_levels(table, "y").collect()}
    assert last == pytest.approx({"a": (9 - 3 * 19 / 4) / 4, "b": (10 - 19 / 4) / 2})


@pytest.mark.parametrize("gap", [1, 3])
def test_levels_know_no_later_label(rows, gap):
    """Changing labels from a day on changes no level up to ``gap`` rows later."""
    day = dt.date(2024, 3, 1)
    changed = rows.withColumn("y", F.when(F.col("date") >= F.lit(day), F.col("y") + 1000).otherwise(F.col("y")))
    both = [
        {(r.city, r.date): r[levels.LEVEL] for r in levels.with_running_levels(t, "y", gap=gap).collect()} for t in (rows, changed)
    ]
    same = {k for k in both[0] if both[0][k] == both[1][k]}
    known = dt.timedelta(days=gap)
    assert {k for k in both[0] if k[1] < day + known} <= same and len(same) < len(both[0])
    # one key's change moves its own level most
    assert levels.with_running_levels(rows, "y", gap=gap).count() == rows.count()


def test_a_million_keys(spark):
    """No part of the model grows with the keys but the stored table."""
    many = spark.range(1_000_000).select(
        F.concat(F.lit("k"), "id").alias("city"), F.expr("date_add(date'2024-01-01', cast(id % 7 as int))").alias("date"),
        (F.col("id") % 13 * 1.0).alias("a"), (F.col("id") % 13 * 2.0 + F.col("id") % 5).alias("y"),
    )
    fitted = fit(many, forest(trees=2, depth=3), ["a"], "y")
    assert fitted.model.stages[-1].numFeatures == 2 and fitted.levels.count() == 1_000_000
    unseen = spark.createDataFrame([("new", dt.date(2025, 1, 1), 1.0), (None, dt.date(2025, 1, 1), 1.0)], "city string, date date, a double")
    assert fitted.score(unseen).where("prediction is not null").count() == 2
