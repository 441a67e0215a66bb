import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.functions.derived import INPUTS, TARGETS, feature_names, with_derived
from panelcast.models import explain, matrix, search
from panelcast.models.fit import fit, fit_forest, fit_linear, fit_log_forest, forest, linear
from panelcast.models.matrix import linear_feature_names
from panelcast.models.registry import ModelRegistry
from panelcast.plans import train
from panelcast.plans.features import latest_serving_rows
from panelcast.plans.sample_queries import BOUNDS, panel, trainable
from panelcast.plans.views import HORIZON_VIEWS, horizon_matrix, view_definitions
from panelcast.session import fresh_folder

MADE = "city string, date date, " + ", ".join(f"{c} double" for c in INPUTS) + ", target_1d double"


@pytest.fixture(scope="module")
def made(spark):
    """600 rows with known weights and key effects; lags are independent noise."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, len(INPUTS)))
    effect = {"a": 5.0, "b": -1.0, "c": 2.0}
    cities = [list(effect)[i % 3] for i in range(600)]
    y = x @ np.arange(1, len(INPUTS) + 1) + np.array([effect[c] for c in cities])
    y = y + rng.normal(size=600)
    days = np.datetime64("2024-01-01") + np.arange(600) // 3
    rows = [
        (c, d.item(), *map(float, r), float(t)) for c, d, r, t in zip(cities, days, x, y, strict=True)
    ]
    table = with_derived(spark.createDataFrame(rows, MADE), 1).persist()
    yield table
    table.unpersist()


@pytest.fixture(scope="module")
def sample_matrix(spark, small):
    table = horizon_matrix(trainable(spark, small), 2).persist()
    yield table
    table.unpersist()


def design(pdf, names):
    """Every feature, redundant ones included, and a column per key."""
    keys = [(pdf.city == c).astype(float) for c in "abc"]
    return np.column_stack([pdf[n] for n in names] + keys)


def minimum_norm_fit(x, y):
    centred = x - x.mean(axis=0)
    weights = np.linalg.lstsq(centred, y - y.mean(), rcond=None)[0]
    return weights, y.mean() - x.mean(axis=0) @ weights


def test_least_squares_equals_the_minimum_norm_solution(spark, made):
    """Predictions, weights and unseen keys agree with a rank-deficient solver
    given all features and one column per key."""
    pdf = made.toPandas()
    names = feature_names(1)
    weights, intercept = minimum_norm_fit(design(pdf, names), pdf.target_1d.to_numpy())
    fitted = fit_linear(made, 1)
    unseen = made.limit(3).withColumn("city", F.lit("z"))
    scored = fitted.score(made.unionByName(unseen)).toPandas()
    expected = design(scored, names) @ weights + intercept
    assert np.abs(scored.prediction - expected).max() < 1e-8
    found = explain.linear_weights(fitted, ["aqi_change_rate"])
    assert [found[n] for n in names] == pytest.approx(weights[: len(names)].tolist(), abs=1e-8)


def test_absorbed_key_effects_give_the_same_forecasts(spark, made):
    """And the same after a round trip through the registry."""
    rows = made.unionByName(made.limit(3).withColumn("city", F.lit("z")))
    names = matrix.linear_feature_names(1)
    levels = sorted(r.city for r in made.select("city").distinct().collect())
    last = (F.col("city") == levels[-1]).cast("double")
    codes = {f"code_{k}": (F.col("city") == k).cast("double") - last for k in levels[:-1]}
    expected = fit(made.withColumns(codes), linear(), [*names, *codes], "target_1d", "linear", key=None)
    absorbed = fit_linear(made, 1)
    assert (expected.form, absorbed.form) == ("pipeline", "absorbed")
    registry = ModelRegistry(spark, fresh_folder(spark, "models"))
    registry.register("m", absorbed, {"r2": 0.5})
    for model in (absorbed, registry.load("m")):
        scored = model.score(rows, "p")
        assert scored.columns == [*rows.columns, "p"]
        both = expected.score(scored.withColumns(codes))
        assert both.agg(F.max(F.abs(F.col("p") - F.col("prediction")))).first()[0] < 1e-8
    background = explain.background_sample(made)
    impacts = [
        explain.linear_attribution(made.limit(4).withColumns(codes), m, background.withColumns(codes), features=["aqi_change_rate"])
        for m in (expected, absorbed)
    ]
    gap = impacts[0].join(
        impacts[1].withColumnRenamed("impact", "other"), ["city", "date", "feature"]
    )
    assert gap.agg(F.max(F.abs(F.col("impact") - F.col("other")))).first()[0] < 1e-8


def test_keys_become_a_sparse_vector(made):
    from pyspark.ml import Pipeline

    from panelcast.models.matrix import matrix_stages

    names = linear_feature_names(1)
    stages = matrix_stages(names)
    estimator = linear().setLabelCol("target_1d")
    model = Pipeline(stages=[*stages, estimator]).fit(made)
    unseen = made.withColumn("city", F.lit("z")).limit(2)
    wide = model.transform(made.unionByName(unseen)).select("city", "date", "prediction")
    narrow = fit_linear(made, 1).score(made)
    both = narrow.select("city", "date", F.col("prediction").alias("p")).join(
        wide, ["city", "date"]
    )
    assert both.agg(F.max(F.abs(F.col("p") - F.col("prediction")))).first()[0] < 1e-4
    assert wide.where("city = 'z'").count() == 2


def test_more_keys_than_columns(spark):
    """A tree tells apart any number of keys; rows without a key are 0 everywhere."""
    rows = spark.range(2400).select(
        F.when(F.col("id") % 601 > 0, F.concat(F.lit("k"), F.col("id") % 601)).alias("city"),
        F.lit(1.0).alias("x"), F.when(F.col("id") % 601 == 7, 9.0).when(F.col("id") % 601 == 0, 4.0).otherwise(1.0).alias("y"),
    )
    fitted = fit(rows, forest(trees=1, depth=1, resample=False), ["x"], "y")
    found = {r.city: r.prediction for r in fitted.score(rows).select("city", "prediction").distinct().collect()}
    assert found["k7"] == 9.0 and len(set(found.values())) == 2 and found[None] == found["k8"]


def test_forest_refit_is_deterministic(sample_matrix):
    def predictions():
        fitted = fit_forest(sample_matrix, 2, trees=5, depth=4)
        return [r[0] for r in fitted.score(sample_matrix).orderBy("city", "date").select("prediction").collect()]

    assert predictions() == predictions()


def test_log_forest_predicts_on_the_label_scale(sample_matrix):
    fitted = fit_log_forest(sample_matrix, 2, trees=5, depth=3)
    row = fitted.score(sample_matrix).agg(F.avg("prediction"), F.avg("target_2d")).first()
    assert 0.5 * row[1] < row[0] < 1.5 * row[1]


def test_views_have_one_label():
    for h, view in HORIZON_VIEWS.items():
        assert view.label == TARGETS[h] and len(view.columns) == 15
        assert not set(TARGETS.values()) & set(view.columns)


def test_view_registers_for_sql(spark, small):
    name = HORIZON_VIEWS[1].register(trainable(spark, small))
    assert spark.table(name).columns[-1] == "target_1d"
    assert view_definitions(spark).count() == 3


def test_full_grids():
    forests = search.combinations(search.FOREST_GRID)
    assert len(forests) == 18 and len(search.combinations(search.BOOSTED_GRID)) == 12
    assert forests[0] == {"depth": 8, "leaf": 1, "trees": 200}


def test_search_trains_on_earlier_rows_only(made, monkeypatch):
    seen = []
    score = search._score

    def spy(model, rows, label):
        seen.append(rows.agg(F.min("_fold"), F.max("_fold")).first())
        return score(model, rows, label)

    monkeypatch.setattr(search, "_score", spy)
    grid = {"depth": [2, 6], "leaf": [1], "trees": [5]}
    result = search.expanding_search(made, "forest", feature_names(1), "target_1d", grid=grid)
    assert sorted(tuple(r) for r in seen) == [(1, 1), (1, 1), (2, 2), (2, 2), (3, 3), (3, 3)]
    means = {
        r.place: r.m for r in result.scores.groupBy("place").agg(F.avg("r2").alias("m")).collect()
    }
    assert result.best.params["depth"] == (2 if means[0] >= means[1] else 6)


def test_train_register_load_and_serve(spark, small):
    table = trainable(spark, small).persist()
    registry = ModelRegistry(spark, fresh_folder(spark, "models"))
    grids = {"forest": {"depth": [3], "leaf": [3], "trees": [5]}}
    for horizon in TARGETS:
        done = train.train_horizon(
            table, horizon, BOUNDS, grids, folds=2, families=["forest"],
            log_params={"trees": 3, "depth": 3} if horizon == 1 else None,
        )
        rows = done.metrics.orderBy("listed").collect()
        assert [r.model for r in rows] == ["linear", "forest"]
        assert done.champion_metrics["r2"] == max(r.r2 for r in rows)
        assert train.register(done, registry) == 1
        assert done.errors.misses.count() == 10 and done.errors.target.count() == 1
        assert (done.log_forest is None) == (horizon != 1)
    assert train.register(done, registry) == 2
    assert registry.models().count() == 4
    table.unpersist()

    models = train.load_models(registry)
    assert registry.load(train.model_name(3), 1).features == tuple(done.champion.features)
    with pytest.raises(KeyError):
        registry.load(train.model_name(1), 7)
    latest = latest_serving_rows(panel(spark, small))
    loaded = train.score_horizons(latest, models).select("city", "prediction_3d").collect()
    fresh = done.champion.score(with_derived(latest)).collect()
    assert {r.city: r.prediction_3d for r in loaded} == {r.city: r.prediction for r in fresh}


def test_sweep_has_a_row_per_setting(made):
    table = train.param_sweep(
        made, made, INPUTS, "target_1d", settings=[{"trees": 2, "depth": 2}, {"trees": 3, "depth": 2}]
    )
    assert table.count() == 2


# --- attributions ---------------------------------------------------------------


def totals(attribution):
    return {
        (r.city, r.date): r.total
        for r in attribution.groupBy("city", "date").agg(F.sum("impact").alias("total")).collect()
    }


@pytest.fixture(scope="module")
def explained(made):
    rows = made.orderBy("date", "city").limit(6)
    return rows, explain.background_sample(made)


def efficiency_gap(attribution, fitted, rows, background):
    base = fitted.score(background).agg(F.avg("prediction")).first()[0]
    found = totals(attribution)
    return max(
        abs(found[(r.city, r.date)] - (r.prediction - base)) for r in fitted.score(rows).collect()
    )


def test_linear_impacts_add_up_and_match_shapley(made, explained):
    """For a linear model sampled Shapley values are exact, whatever the order."""
    rows, background = explained
    fitted = fit_linear(made, 1)
    closed = explain.linear_attribution(rows, fitted, background)
    sampled = explain.shapley_attribution(rows, fitted, background, pairs=2)
    assert efficiency_gap(closed, fitted, rows, background) < 1e-9
    both = closed.join(
        sampled.withColumnRenamed("impact", "other"), ["city", "date", "feature"]
    )
    assert both.count() == 6 * (len(fitted.features) + 1)
    assert both.agg(F.max(F.abs(F.col("impact") - F.col("other")))).first()[0] < 1e-9


def test_redundant_features_share_the_impact(made, explained):
    rows, background = explained
    fitted = fit_linear(made, 1)
    spread = explain.linear_attribution(rows, fitted, background, features=["aqi_change_rate"])
    assert efficiency_gap(spread, fitted, rows, background) < 1e-9
    change = spread.where("feature = 'aqi_change_rate'").agg(F.max(F.abs("impact"))).first()[0]
    assert change > 1e-3


def test_forest_impacts_add_up(made, explained):
    rows, background = explained
    fitted = fit_forest(made, 1, trees=5, depth=4)
    impacts = explain.shapley_attribution(rows, fitted, background, pairs=2)
    assert efficiency_gap(impacts, fitted, rows, background) < 1e-9


def test_shapley_of_a_small_model_against_all_orders(spark, made):
    """Three features, every order: the definition itself."""
    names = ["pm2_5", "pm10", "humidity"]
    fitted = fit(made, forest(trees=4, depth=4), names, "target_1d", key=None)
    rows, background = made.limit(1), explain.background_sample(made, n=4)
    found = {
        r.feature: r.impact
        for r in explain.shapley_attribution(rows, fitted, background, pairs=300).collect()
    }
    x = rows.first()
    mixes, weights = [], []
    for other in background.collect():
        for order in itertools.permutations(range(3)):
            values = [other[n] for n in names]
            mixes.append(tuple(values))
            for place in order:
                values[place] = x[names[place]]
                mixes.append(tuple(values))
            weights.append(order)
    schema = "i int, " + ", ".join(f"{n} double" for n in names)
    table = spark.createDataFrame([(i, *m) for i, m in enumerate(mixes)], schema)
    f = [r.prediction for r in fitted.score(table).orderBy("i").collect()]
    expected = dict.fromkeys(names, 0.0)
    for k, order in enumerate(weights):
        for step, place in enumerate(order):
            expected[names[place]] += (f[4 * k + step + 1] - f[4 * k + step]) / len(weights)
    for n in names:
        assert found[n] == pytest.approx(expected[n], abs=0.8)
    assert sum(found.values()) == pytest.approx(sum(expected.values()))


def test_top_impacts(spark):
    rows = [("a", f"f{i}", (-1.0) ** i * i) for i in range(14)]
    df = spark.createDataFrame(rows, "city string, feature string, impact double")
    top = explain.top_impacts(df, ["city"], 10).orderBy("place").collect()
    assert [r.feature for r in top] == [f"f{i}" for i in range(4, 14)]
    assert top[-1].direction == "lowers" and top[0].direction == "raises"


def test_forest_does_not_depend_on_the_number_of_tasks(made, monkeypatch):
    """The same rows from 1 and from 7 stored parts, forests of several tasks."""
    monkeypatch.setattr(matrix, "ROWS_PER_PART", 100)
    sums = {
        fit_forest(made.repartition(n), 1, trees=5, depth=4).score(made).agg(F.sum("prediction")).first()[0]
        for n in (1, 7)
    }
    context = made.sparkSession.sparkContext
    monkeypatch.setattr(type(context), "defaultParallelism", property(lambda self: 3))
    sums.add(fit_forest(made, 1, trees=5, depth=4).score(made).agg(F.sum("prediction")).first()[0])
    assert len({round(s, 6) for s in sums}) == 1


def test_rows_without_a_key_share_an_effect(made):
    rows = made.withColumn("city", F.when(F.col("city") != "a", F.col("city")))
    named = made.withColumn("city", F.when(F.col("city") != "a", F.col("city")).otherwise("none"))
    gap = fit_linear(rows, 1).score(rows, "p").join(fit_linear(named, 1).score(named, "q").drop("city"), [c for c in made.columns if c != "city"])
    assert gap.agg(F.max(F.abs(F.col("p") - F.col("q")))).first()[0] < 1e-8


def test_two_writers_get_two_versions(spark, made):
    """Both look at the registry before either has registered."""
    from panelcast.models.together import together

    registry = ModelRegistry(spark, fresh_folder(spark, "models"))
    fitted = fit_linear(made, 1)
    versions = together(spark, lambda i: registry.register("m", fitted, {"r2": float(i)}), range(4), 4)
    assert sorted(versions) == [1, 2, 3, 4]
    assert registry.models().where("name = 'm'").count() == 4 and registry.load("m", 3).features == fitted.features
    assert registry.register("m", fitted, {}) == 5
