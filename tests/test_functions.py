import random

import pytest
from panelcast.functions import bands, calendar, derived, numbers
from panelcast.functions.missing import nan_to_null

NAN = float("nan")


def values(spark, items, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], "i int, x double")
    return [r.y for r in df.select("i", column.alias("y")).orderBy("i").collect()]


def test_nan_becomes_null(spark):
    df = nan_to_null(spark.createDataFrame([(NAN, "a"), (1.0, "b")], "`a.b` double, s string"))
    assert [r[0] for r in df.collect()] == [None, 1.0]


def test_times_survive_a_clock_change(spark):
    """02:30 does not exist that night in New York; a zone-free time does not care."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2024-03-10T02:30",)], "t string")
        time = calendar.parse_time("t")
        row = df.select(
            calendar.time_text(time).alias("text"), calendar.hour_start(time).alias("hour")
        ).first()
        assert (row.text, str(row.hour)) == ("2024-03-10T02:30", "2024-03-10 02:00:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_band_edges(spark):
    items = [50.0, 50.01, 100.0, 150.0, 150.01, 200.0, 300.0, 300.01, None, NAN]
    names = values(spark, items, bands.band_name("x"))
    assert names == [
        "Good", "Moderate", "Moderate", "Unhealthy for Sensitive Groups", "Unhealthy",
        "Unhealthy", "Very Unhealthy", "Hazardous", None, None,
    ]
    assert values(spark, [None, NAN], bands.band_name("x", missing_is_top=True)) == ["Hazardous"] * 2
    assert values(spark, [50.0, None], bands.band_colour("x")) == ["#2ecc71", None]
    hazards = values(spark, items, bands.is_hazard("x"))
    assert hazards == [False] * 4 + [True] * 4 + [False] * 2


def test_half_even(spark):
    assert values(spark, [0.5, 1.5, 2.5, -0.5], numbers.half_even("x")) == [0.0, 2.0, 2.0, 0.0]
    assert values(spark, [0.125, 0.375, 2.675], numbers.half_even("x", 2)) == [0.12, 0.38, 2.68]


def test_number_texts_match_exact_rounding(spark):
    pick = random.Random(7)
    items = [0.05, 0.15, 0.25, 0.35, 0.45, 12.35, 12.45, 9.95, 99.95, 0.0, 1013.25, -0.35, -12.25]
    items += [round(pick.uniform(-50, 1100), 2) for _ in range(2000)]
    items += [pick.uniform(0, 1) for _ in range(500)]
    assert values(spark, items, numbers.tenths_text("x")) == [f"{x:.1f}" for x in items]
    items = [0.5, 1.5, 2.5, 99.5, 100.49999]
    assert values(spark, items, numbers.whole_text("x")) == [f"{x:.0f}" for x in items]
    assert values(spark, [None], numbers.tenths_text("x")) == [None]


def test_log_target_round_trip(spark):
    back = numbers.from_log_target(numbers.log_target("x"))
    assert values(spark, [0.0, 1.5, 400.0], back) == pytest.approx([0.0, 1.5, 400.0])


def test_direction(spark):
    assert values(spark, [1.0, 0.0, -1.0, None], numbers.direction("x")) == [
        "raises", "lowers", "lowers", None,
    ]


def test_calendar(spark):
    df = spark.createDataFrame([("2024-01-01T05:30",)], "t string").select(
        calendar.parse_time("t").alias("t")
    )
    row = df.select(
        calendar.hour_start("t").alias("hour_start"),
        calendar.hour_of_day("t").alias("hour"),
        calendar.day_of_week("t").alias("dow"),
        calendar.month_of_year("t").alias("month"),
        calendar.label(calendar.day_of("t"), calendar.SHORT_LABEL).alias("short"),
        calendar.label(calendar.day_of("t"), calendar.LONG_LABEL).alias("long"),
    ).first()
    assert str(row.hour_start) == "2024-01-01 05:00:00"
    assert tuple(row)[1:] == (5, 0, 1, "Mon, Jan 01", "Monday, Jan 01")


def test_derived_features(spark):
    row = {
        "pm25_lag_1": 10.0, "pm25_lag_3": 4.0, "pm25_lag_7": None, "pm25_rolling_7": 12.0,
        "humidity": 60.0, "wind_speed": -1.0, "pressure": 1000.0,
    }
    schema = ", ".join(f"{k} double" for k in row)
    df = spark.createDataFrame([tuple(row.values())], schema)
    found = df.select(*(c.alias(n) for n, c in derived.derived_columns().items())).first()
    assert found.asDict() == {
        "aqi_change_rate": 2.0, "volatility_7": 2.0, "wind_stagnation": None,
        "pressure_humidity": 60.0, "pm25_trend": None, "pm25_rolling_max_7": 12.0,
    }
    assert derived.feature_names(1)[-1] == "aqi_change_rate" and len(derived.feature_names(2)) == 19
