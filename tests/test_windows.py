import random

import pytest
from frames import by_key, day, panel
from pyspark.sql import functions as F

from panelcast.operators.windows import (
    DAILY_RECIPE,
    WindowRecipe,
    latest_rows,
    with_windows,
)
from panelcast.plans import features
from panelcast.spec import PanelSpec

SPEC = PanelSpec(("city",), "date", ("pm2_5",))
RECIPE = WindowRecipe(lags=(1, 3), trailing=(3,), leads=(1, 2))


def test_windows_count_rows_not_days(spark):
    df = with_windows(
        panel(spark, [("a", 0, 1.0), ("a", 1, 2.0), ("a", 4, 3.0), ("a", 5, 4.0)]), SPEC, RECIPE
    )
    found = by_key(df, "pm25_lag_1", "pm25_lag_3", "pm25_rolling_3", "target_1d", "target_2d")
    assert found[("a", day(4))] == (2.0, None, None, 4.0, None)
    assert found[("a", day(5))] == (3.0, 1.0, 2.0, None, None)
    assert found[("a", day(0))] == (None, None, None, 2.0, 3.0)


def test_a_hole_blanks_every_mean_that_covers_it(spark):
    rows = [("a", i, None if i == 3 else float(i)) for i in range(10)]
    found = by_key(with_windows(panel(spark, rows), SPEC, RECIPE), "pm25_rolling_3")
    assert [i for i in range(10) if found[("a", day(i))][0] is None] == [0, 1, 2, 4, 5, 6]
    assert found[("a", day(7))] == (5.0,)


def test_include_current(spark):
    recipe = WindowRecipe(trailing=(3,), include_current=True)
    rows = [("a", i, float(i)) for i in range(5)]
    found = by_key(with_windows(panel(spark, rows), SPEC, recipe), "pm25_rolling_3")
    assert [found[("a", day(i))][0] for i in range(5)] == [None, None, 1.0, 2.0, 3.0]


def test_keys_do_not_leak_into_each_other(spark):
    rows = [("a", i, 1e9) for i in range(9)] + [("b", i, 1.0) for i in range(9)]
    found = by_key(with_windows(panel(spark, rows), SPEC, DAILY_RECIPE), *DAILY_RECIPE.names())
    assert all(v in (None, 1.0) for (c, _), vs in found.items() if c == "b" for v in vs)
    assert found[("b", day(0))][:5] == (None,) * 5


def test_short_series_yield_no_training_rows(spark):
    rows = [(f"k{n}", i, float(i)) for n in (1, 2, 7, 10, 11) for i in range(n)]
    table = features.daily_features(panel(spark, rows), SPEC)
    assert [r.city for r in features.training_rows(table).collect()] == ["k11"]
    assert features.serving_rows(table).count() == 3 + 4
    assert features.latest_serving_rows(table, SPEC).count() == 2


def test_later_values_never_change_a_feature(spark):
    rows = [(c, i, float(i * i % 7)) for c in "ab" for i in range(20)]
    changed = [(c, i, v + 100 if c == "a" and i >= 12 else v) for c, i, v in rows]
    names = [n for n in DAILY_RECIPE.names() if not n.startswith("target")]
    before = by_key(with_windows(panel(spark, rows), SPEC, DAILY_RECIPE), *names)
    after = by_key(with_windows(panel(spark, changed), SPEC, DAILY_RECIPE), *names)
    touched = {key for key in before if before[key] != after[key]}
    assert touched and all(c == "a" and d > day(12) for c, d in touched)


@pytest.mark.parametrize(
    ("unit", "density"), [("day", 0.3), ("week", 0.05), ("week", 0.9), ("month", 0.05), ("year", 0.4)]
)
def test_chunks_equal_plain_windows(spark, unit, density):
    """Sparse series have many chunks holding fewer rows than a window spans."""
    pick = random.Random(f"{unit}{density}")
    rows = [
        (c, i, None if pick.random() < 0.1 else float(pick.randint(0, 999)))
        for c in ("a", "b", "hot")
        for i in range(700)
        if pick.random() < (0.99 if c == "hot" else density)
    ]
    recipe = WindowRecipe(lags=(1, 3, 7), trailing=(3, 7), leads=(1, 2, 10))
    df = panel(spark, rows)
    plain = by_key(with_windows(df, SPEC, recipe), "pm2_5", *recipe.names())
    chunked = by_key(with_windows(df, SPEC, recipe, unit), "pm2_5", *recipe.names())
    assert plain == chunked


def test_chunks_without_a_look_back_or_ahead(spark):
    df = panel(spark, [("a", i, float(i)) for i in range(40)])
    for recipe in (WindowRecipe(leads=(2,)), WindowRecipe(lags=(2,)), WindowRecipe()):
        assert by_key(with_windows(df, SPEC, recipe, "week"), *recipe.names()) == by_key(
            with_windows(df, SPEC, recipe), *recipe.names()
        )


def test_chunks_with_repeated_and_missing_times(spark):
    """Rows of one moment keep their number; a row without time is its series' first."""
    rows = [("a", i // 2, 1.0) for i in range(80)] + [(None, i, 1.0) for i in range(40)]
    df = panel(spark, rows).unionByName(panel(spark, [("a", 0, 1.0)]).withColumn("date", F.lit(None).cast("date")))
    recipe = WindowRecipe(lags=(1, 3), trailing=(3,), leads=(1, 2))
    for unit in (None, "day", "week", "month"):
        out = with_windows(df, SPEC, recipe, unit).orderBy("city", "date")
        assert out.columns == [*df.columns, *recipe.names()]
        found = out.groupBy("city").agg(*(F.count(c).alias(c) for c in recipe.names()), F.count("*").alias("n")).collect()
        assert sorted((r.city or "", r.n, *(r[c] for c in recipe.names())) for r in found) == [
            ("", 40, 39, 37, 37, 39, 38), ("a", 81, 80, 78, 78, 80, 79),
        ]


def test_latest_rows(spark):
    df = panel(spark, [("a", 1, 1.0), ("a", 3, 3.0), ("b", 2, 2.0)])
    assert {(r.city, r.pm2_5) for r in latest_rows(df, SPEC).collect()} == {("a", 3.0), ("b", 2.0)}
