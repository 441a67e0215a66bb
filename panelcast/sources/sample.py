"""Panels derived from the sample star schema, used by the registered queries.

H: hourly air measures per event type. W: hourly weather measures of the same
keys, reported half an hour late, so some hours exist on one side only.
P: daily panel per order priority; ship-date averages play the weather.

The odd scale factors keep averages off the ties of six-decimal rounding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.functions.calendar import hour_start


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _reading() -> Column:
    return F.get_json_object("props", "$.k").cast("double")


def hourly_air(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return events.groupBy(F.col("event_type").alias("city"), hour_start("ts").alias("time")).agg(
        (F.avg("value") / 0.97).alias("pm2_5"),
        (F.avg(_reading()) / 0.97).alias("pm10"),
    )


def hourly_weather(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    reported = F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(30))
    return events.groupBy(
        F.col("event_type").alias("city"), hour_start(reported).alias("time")
    ).agg(
        (F.avg(_reading()) / 1.94).alias("temperature"),
        (F.avg(F.col("user_id") % 100) / 0.97).alias("humidity"),
        (F.avg(F.col("event_id") % 20) / 0.97).alias("wind_speed"),
        (F.avg(_reading()) / 0.97 + 900.0).alias("pressure"),
    )


def daily_panel(spark: SparkSession, folder: str) -> DataFrame:
    air = (
        table(spark, folder, "orders")
        .groupBy(F.col("o_orderpriority").alias("city"), F.to_date("o_orderdate").alias("date"))
        .agg(
            (F.avg("o_totalprice") / 997.0).alias("pm2_5"),
            (F.max("o_totalprice") / 997.0).alias("pm10"),
        )
    )
    weather = (
        table(spark, folder, "lineitem")
        .groupBy(F.to_date("l_shipdate").alias("date"))
        .agg(
            F.avg("l_quantity").alias("temperature"),
            (F.avg("l_discount") * 997.0).alias("humidity"),
            (F.avg("l_tax") * 97.0).alias("wind_speed"),
            (F.avg("l_extendedprice") / 47.0).alias("pressure"),
        )
    )
    return air.join(weather, "date").select("city", "date", *_MEASURES)


_MEASURES = ("pm2_5", "pm10", "temperature", "humidity", "wind_speed", "pressure")
