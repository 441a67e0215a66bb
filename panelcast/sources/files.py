"""CSV files in and out, with declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from panelcast.functions.calendar import parse_time
from panelcast.functions.missing import nan_to_null
from panelcast.spec import AIR_CSV, DAILY_CSV, WEATHER_CSV


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A headed CSV. Empty cells are NULL; a header, cell or line that disagrees raises."""
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
    # all cells are parsed, so that a line's length and types are seen whatever is read of it
    reader = reader.option("mode", "FAILFAST").option("columnPruning", False)
    return nan_to_null(reader.csv(path))


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A folder of headed CSV parts, one per task, with no index column."""
    df.write.mode(mode).option("header", True).csv(path)


def read_air_csv(spark: SparkSession, path: str) -> DataFrame:
    """The historical air file, its dotted column names replaced."""
    rows = read_csv(spark, path, AIR_CSV).toDF("time", "pm10", "pm2_5")
    return rows.withColumn("time", parse_time("time"))


def read_weather_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, WEATHER_CSV).withColumn("time", parse_time("time"))


def read_daily_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, DAILY_CSV)
