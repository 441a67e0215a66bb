import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelcast.operators import clean
from panelcast.operators.daily import daily_mean, daily_mean_of_feeds, join_feeds
from panelcast.plans.features import calendar_features
from panelcast.plans.ingest import refreshed_days
from panelcast.spec import PanelSpec

T0 = dt.datetime(2024, 1, 1)
AIR = "city string, time timestamp_ntz, pm2_5 double, pm10 double"
WEATHER = (
    "city string, time timestamp_ntz, temperature double, humidity double, wind_speed double, "
    "pressure double"
)


def hour(n):
    return T0 + dt.timedelta(hours=n)


def feeds(spark, air, weather):
    return (
        spark.createDataFrame([(c, hour(h), v, v) for c, h, v in air], AIR),
        spark.createDataFrame([(c, hour(h), v, v, v, v) for c, h, v in weather], WEATHER),
    )


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_null_keys_never_match(spark):
    air, weather = feeds(spark, [(None, 0, 1.0), ("a", 0, 1.0)], [(None, 0, 2.0), ("a", 0, 2.0)])
    assert join_feeds(air, weather).count() == 1


def test_mean_skips_missing_hours(spark):
    air, weather = feeds(
        spark, [("a", 0, 1.0), ("a", 1, None), ("a", 2, 5.0)], [("a", h, 2.0) for h in range(9)]
    )
    row = daily_mean(join_feeds(air, weather)).first()
    assert (row.pm2_5, row.temperature, row.n_obs) == (3.0, 2.0, 3)


@pytest.mark.parametrize("copies", [1, 4])
def test_reducing_before_the_join_changes_nothing(spark, copies):
    """Including hours that were delivered several times, by either feed."""
    air = [("a", h, float(h % 5) if h % 7 else None) for h in range(60) for _ in range(1 + h % copies)]
    weather = [("a", h, float(h)) for h in range(10, 80) for _ in range(1 + (h // 2) % copies)]
    air, weather = feeds(spark, [*air, ("b", 1, None)], [*weather, ("b", 1, 4.0)])
    joined = daily_mean(join_feeds(air, weather))
    reduced = daily_mean_of_feeds(air, weather).select(*joined.columns)
    for a, b in zip(rows(joined), rows(reduced), strict=True):
        assert a == pytest.approx(b)


def test_future_hours(spark):
    air, _ = feeds(spark, [("a", h, 1.0) for h in (0, 11, 12, 13, 23, 24, 30)], [("a", 0, 1.0)])
    as_of = T0.replace(hour=12)
    assert clean.observed_hours(air, as_of).count() == 5
    assert clean.observed_hours(air, as_of, strict=True).count() == 3


def test_refresh_window(spark):
    air, weather = feeds(
        spark, [("a", h, 1.0) for h in range(240)], [("a", h, 1.0) for h in range(240)]
    )
    days = refreshed_days(air, weather, dt.date(2024, 1, 6))
    assert [r.date.day for r in days.orderBy("date").collect()] == [3, 4, 5, 6]


def test_trailing_days_are_global_or_per_key(spark):
    df = spark.createDataFrame(
        [("a", dt.date(2024, 1, d), 1.0) for d in range(1, 31)]
        + [("b", dt.date(2024, 1, d), 1.0) for d in range(1, 11)],
        "city string, date date, pm2_5 double",
    )
    assert clean.trailing_days(df, 5).groupBy("city").count().collect()[0]["count"] == 6
    per_key = clean.trailing_days(df, 5, keys=["city"])
    assert {r.city: r["count"] for r in per_key.groupBy("city").count().collect()} == {"a": 6, "b": 6}
    assert clean.trailing_days(df.where("city = 'z'"), 5).count() == 0


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("city"), F.lit(T0).alias("date"))
    one = rows(clean.sample_rows(df.repartition(1), 20, ["city", "date"]))
    assert one == rows(clean.sample_rows(df.repartition(13, "city"), 20, ["city", "date"]))
    assert len(one) == 20 and one != rows(clean.sample_rows(df, 20, ["city", "date"], seed=1))


def test_two_key_columns(spark):
    air, weather = feeds(spark, [("a", 0, 1.0), ("a", 1, 3.0)], [("a", 0, 2.0), ("a", 1, 2.0)])
    air, weather = (f.withColumn("device", F.lit("x")) for f in (air, weather))
    found = daily_mean_of_feeds(air, weather, key=("city", "device")).select("city", "device", "date", "pm2_5", "n_obs")
    plain = daily_mean(air, ("pm2_5",), ("city", "device")).select("city", "device", "date", "pm2_5", "n_obs")
    assert rows(found) == rows(plain) == [("a", "x", T0.date(), 2.0, 2)]


def test_gaps_are_filled_step_by_step(spark):
    spec = PanelSpec(("k",), "d", ("v",))
    day = dt.date(2024, 1, 1)
    table = [("a", 0, 1.0), ("a", 3, 2.0), ("a", 3, 2.0), ("b", 0, 5.0), (None, 0, 6.0), (None, 2, None), ("a", None, 9.0)]
    made = spark.createDataFrame([(k, None if n is None else day + dt.timedelta(days=n), v) for k, n, v in table], "k string, d date, v double")
    found = [(r.k, r.d and (r.d - day).days, r.v, r._filled) for r in clean.gap_filled(made, spec).collect()]
    order = lambda r: tuple((x is not None, x or 0) for x in r)
    given = [(*r, False) for r in table]
    assert sorted(found, key=order) == sorted([*given, ("a", 1, None, True), ("a", 2, None, True), (None, 1, None, True)], key=order)
    assert clean.gap_filled(made.limit(0), spec).collect() == []
    hours = spark.createDataFrame([("a", T0), ("a", hour(2))], "k string, d timestamp_ntz")
    assert rows(clean.gap_filled(hours, spec, "1 HOUR").where("_filled")) == [("a", hour(1), True)]


def test_filled_windows_share_a_shuffle(spark):
    n = F.floor(F.col("id") / 2)
    date = F.date_add(F.lit(dt.date(2024, 1, 1)), (n * 2).cast("int"))
    day = spark.range(50).select((F.col("id") % 2).cast("string").alias("city"), date.alias("date"), n.cast("double").alias("pm2_5"))
    found = calendar_features(day, PanelSpec(("city",), "date", ("pm2_5",)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    third = found.where("date = DATE '2024-01-05'").first()
    assert (third.pm25_lag_1, third.pm25_lag_3, third.target_1d, third.target_2d, third.pm25_rolling_3) == (None, None, None, 3.0, None)
