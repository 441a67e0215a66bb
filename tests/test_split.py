import pytest
from frames import day, panel

from panelcast.operators import metrics, reshape, split


@pytest.mark.parametrize(
    ("days", "starts"), [(10, [4, 6, 8]), (11, [5, 7, 9]), (4, [1, 2, 3])]
)
def test_folds_by_hand(spark, days, starts):
    df = panel(spark, [(c, i, 1.0) for c in "ab" for i in reversed(range(days))])
    folds = split.expanding_folds(df)
    assert list(folds.starts) == [day(s) for s in starts]
    rows = df.select("date", split.fold_number(df, folds).alias("f")).distinct().collect()
    size = days // 4
    assert {r.date: r.f for r in rows} == {
        day(i): 0 if i < starts[0] else 1 + (i - starts[0]) // size for i in range(days)
    }


def test_too_few_times(spark):
    with pytest.raises(ValueError, match="too few"):
        split.expanding_folds(panel(spark, [("a", i, 1.0) for i in range(3)]))


def test_bounds_are_inclusive(spark):
    df = panel(spark, [("a", i, 1.0) for i in range(10)])
    bounds = split.SplitBounds(day(1), day(3), day(5), day(8))
    train, test = split.event_time_split(df, bounds)
    assert sorted(r.date for r in train.collect()) == [day(1), day(2), day(3)]
    assert sorted(r.date for r in test.collect()) == [day(i) for i in (5, 6, 7, 8)]
    tags = df.select(split.split_tag(bounds).alias("t")).collect()
    assert [r.t for r in tags].count(None) == 3


@pytest.mark.parametrize("n", [1, 4, 7, 10, 33])
def test_chronological_share(spark, n):
    df = panel(spark, [("a", i, 1.0) for i in range(n)])
    tags = [r.t for r in df.select(split.chronological_tag(df, "date").alias("t")).collect()]
    assert tags.count("train") == int(n * 0.8)


def test_moments_stay_whole(spark):
    df = panel(spark, [(c, i, 1.0) for c in "abc" for i in range(10)])
    tagged = df.select("date", split.chronological_tag(df, "date").alias("t")).distinct()
    assert tagged.count() == 10


def test_one_hot_levels_come_from_train(spark):
    train = panel(spark, [("a", 0, 1.0), ("gone", 0, 1.0)])
    test = panel(spark, [("a", 1, 1.0), ("new", 1, 1.0), (None, 1, 1.0)])
    columns = reshape.one_hot("city", reshape.key_levels(train, "city"))
    rows = test.select("city", *(c.alias(n) for n, c in columns.items())).collect()
    assert {r.city: tuple(r)[1:] for r in rows} == {"a": (1, 0), "new": (0, 0), None: (0, 0)}
    with pytest.raises(ValueError, match="more than 1"):
        reshape.key_levels(train, "city", 1)


def test_align(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "b double, extra double")
    assert [r.asDict() for r in reshape.align_columns(df, ["a", "b"]).collect()] == [
        {"a": 0.0, "b": 1.0}
    ]


def test_metrics(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 2.0), ("a", 3.0, 3.0), ("b", 5.0, 3.0), ("b", None, 9.0)],
        "city string, y double, p double",
    )
    row = metrics.regression_metrics(df, "y", "p").first()
    assert (row.n, row.mae) == (3, 1.0)
    assert row.rmse == pytest.approx((5 / 3) ** 0.5)
    assert row.r2 == pytest.approx(1 - 5 / 8)
    assert {r.city: r.mae for r in metrics.key_mae(df, "y", "p", "city").collect()} == {
        "a": 0.5, "b": 2.0,
    }
    miss = metrics.biggest_misses(df, "y", "p", ["city"], 1).collect()
    assert [(r.city, r.error) for r in miss] == [("b", 2.0)]


def test_r2_far_from_zero_and_constant(spark):
    df = spark.createDataFrame([(1e9 + i, 1e9 + i + 0.5) for i in range(10)], "y double, p double")
    assert metrics.regression_metrics(df, "y", "p").first().r2 == pytest.approx(1 - 2.5 / 82.5)
    flat = spark.createDataFrame([(2.0, 2.0), (2.0, 2.0)], "y double, p double")
    assert metrics.regression_metrics(flat, "y", "p").first().r2 == 1.0
    off = spark.createDataFrame([(2.0, 2.0), (2.0, 3.0)], "y double, p double")
    assert metrics.regression_metrics(off, "y", "p").first().r2 == 0.0


def test_champion_takes_the_first_of_a_tie(spark):
    rows = [(0, "a", 0.4), (1, "b", 0.5), (2, "c", 0.5)]
    df = spark.createDataFrame(rows, "listed bigint, model string, r2 double").repartition(3)
    assert metrics.champion(df).first().model == "b"


def test_any_alert(spark):
    df = spark.createDataFrame(
        [("a", 10.0), ("a", 151.0), ("b", 150.0), ("b", float("nan"))], "city string, v double"
    )
    assert {r.city: r.alert for r in metrics.any_alert(df, "v", ["city"]).collect()} == {
        "a": True, "b": False,
    }
