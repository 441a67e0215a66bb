"""Fits from stored moments against fits from rows."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.models import absorb
from panelcast.models.absorb import fit_absorbed
from panelcast.models.statistics import LinearStatistics
from panelcast.operators.split import expanding_folds
from panelcast.session import fresh_folder, saved
from panelcast.sources.store import PanelStore

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    """Far from zero, so that lost digits would show; some rows without a key."""
    rng = np.random.default_rng(2)
    x = rng.normal(size=(900, 3)) * [1, 10, 0.1] + [1000, 5000, 300]
    y = x @ [2.0, -0.5, 30.0] + rng.normal(size=900)
    keys = ["p", "q", "r", None]
    data = [
        (keys[i % 4], dt.date(2024, 1, 1) + dt.timedelta(days=i // 4), *map(float, v), float(t) + i % 4)
        for i, (v, t) in enumerate(zip(x, y, strict=True))
    ]
    return saved(spark.createDataFrame(data, "city string, date date, a double, b double, c double, y double"), "rows")


@pytest.fixture
def statistics(spark):
    return LinearStatistics.in_store(PanelStore(spark, fresh_folder(spark, "store")), "moments", NAMES, "y")


def same(one, other, rows):
    assert one.weights == pytest.approx(other.weights, rel=1e-9)
    gap = one.score(rows, "p").join(other.score(rows, "q").select("a", "b", "q"), ["a", "b"]).agg(F.max(F.abs(F.col("p") - F.col("q")))).first()[0]
    assert gap < 1e-6


def test_the_fit_is_that_of_the_rows(statistics, rows):
    statistics.update(rows)
    same(statistics.fit(), fit_absorbed(rows, NAMES, "y"), rows)


def test_fold_fits_are_separate_fits(statistics, rows):
    statistics.update(rows)
    folds = expanding_folds(rows)
    assert any(s.day != 1 for s in folds.starts)
    for i, fitted in statistics.fold_fits(folds, rows).items():
        same(fitted, fit_absorbed(rows.where(F.col("date") < F.lit(folds.starts[i - 1])), NAMES, "y"), rows)
    with pytest.raises(ValueError, match="inside a month"):
        statistics.fit(dt.date(2024, 3, 9))
    same(statistics.fit(dt.date(2024, 3, 1)), fit_absorbed(rows.where("date < '2024-03-01'"), NAMES, "y"), rows)


def test_a_new_month_reads_that_month_only(spark, statistics, rows):
    """The stored moments of the other months stay as they are, and the refit reads no rows."""
    table = PanelStore(spark, fresh_folder(spark, "store")).get_or_create("rows", ("a", "date"), "date")
    table.upsert(rows.where("date < '2024-07-01'"))
    statistics.update(table.read())
    table.upsert(rows.where("date >= '2024-07-01'"))
    new = table.read(parts=["2024-07", "2024-08"])
    assert {f.split("month_part=")[1][:7] for f in new.inputFiles()} == {"2024-07", "2024-08"}
    before = {r.month: r.n for r in statistics.table.read().groupBy("month").agg(F.sum("n").alias("n")).collect()}
    statistics.update(new)
    after = {r.month: r.n for r in statistics.table.read().groupBy("month").agg(F.sum("n").alias("n")).collect()}
    assert {m: n for m, n in after.items() if m < dt.date(2024, 7, 1)} == before
    same(statistics.fit(), fit_absorbed(rows, NAMES, "y"), rows)


def test_a_month_given_again_replaces_itself(statistics, rows):
    statistics.update(rows.withColumn("y", F.col("y") * 2).where("date < '2024-03-01'"))
    statistics.update(rows)
    same(statistics.fit(), fit_absorbed(rows, NAMES, "y"), rows)


def keyed(spark, levels):
    """Rows of 40 keys, one of them null, whose columns lie ``levels`` apart, with the weights and effects of numpy."""
    rng = np.random.default_rng(3)
    key = np.arange(2000) % 40
    x = rng.normal(size=(2000, 2)) + key[:, None] * levels
    y = x @ [2.0, -3.0] + rng.normal(size=2000) + key * levels
    each = [np.flatnonzero(key == k) for k in range(40)]
    within = lambda v: v - np.array([v[i].mean(axis=0) for i in each])[key]
    weights = np.linalg.lstsq(within(x), within(y), rcond=None)[0]
    effects = {k or None: y[i].mean() - x[i].mean(axis=0) @ weights for k, i in enumerate(each)}
    data = [(int(k) or None, float(a), float(b), float(t)) for k, (a, b), t in zip(key, x, y, strict=True)]
    return spark.createDataFrame(data, "key long, a double, b double, y double"), weights, effects


def fits(fitted, weights, effects):
    assert fitted.weights == pytest.approx(weights.tolist(), rel=1e-9)
    assert {r.key: r._effect for r in fitted.effects.collect()} == pytest.approx(effects, rel=1e-9)
    assert fitted.unseen == pytest.approx(np.mean(list(effects.values())), rel=1e-9)


def test_a_fit_with_many_keys_moves_no_rows(spark, monkeypatch):
    rows, weights, effects = keyed(spark, 0.1)

    def refused(*_, **__):
        raise AssertionError("the rows are joined with the means of their keys")

    monkeypatch.setattr(type(rows), "join", refused)
    monkeypatch.setattr(absorb, "SUMS", 4)  # 6 products: two passes
    fits(fit_absorbed(rows, ["a", "b"], "y", "key"), weights, effects)


def test_keys_that_explain_nearly_everything_lose_no_digits(spark):
    rows, weights, effects = keyed(spark, 1e5)
    fits(fit_absorbed(rows, ["a", "b"], "y", "key"), weights, effects)


@pytest.mark.parametrize("value", ["CAST(NULL AS DOUBLE)", "double('NaN')", "double('Infinity')"])
@pytest.mark.parametrize("column", ["a", "y"])
def test_rows_that_cannot_be_fitted_are_refused(spark, column, value):
    rows, _, _ = keyed(spark, 0.1)
    broken = rows.limit(1).withColumn(column, F.expr(value))
    with pytest.raises(ValueError, match="1 of 2001 rows lack a finite value"):
        fit_absorbed(rows.unionByName(broken), ["a", "b"], "y", "key")
    with pytest.raises(ValueError, match="no rows"):
        fit_absorbed(rows.where("false"), ["a", "b"], "y", "key")
