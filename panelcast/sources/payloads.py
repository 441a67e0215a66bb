"""Landed service payloads: one JSON document of parallel arrays per key and fetch."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.functions.calendar import parse_time, time_text
from panelcast.functions.missing import nan_to_null
from panelcast.spec import (
    AIR_FIELDS,
    AIR_PAYLOAD,
    CURRENT_PAYLOAD,
    WEATHER_FIELDS,
    WEATHER_PAYLOAD,
)


# When and from which file a row landed: of two copies of an hour, the one
# landed last holds.
LANDED = ("landed_at", "landed_file")


def hourly_rows(
    payloads: DataFrame, fields: Mapping[str, str], keep: Sequence[str] = ()
) -> DataFrame:
    """Unroll ``hourly{time[], field[], ...}`` to one row per city and hour."""
    names = ["time", *fields]
    zipped = F.arrays_zip(*(F.col(f"hourly.{n}").alias(n) for n in names))
    missing = F.raise_error(F.lit("a payload has no city")).cast("string")
    city = F.coalesce("city", missing).alias("city")
    rows = payloads.select(city, *keep, F.inline(zipped).alias(*names))
    return nan_to_null(
        rows.select(
            "city",
            parse_time("time").alias("time"),
            *(F.col(source).alias(target) for source, target in fields.items()),
            *keep,
        )
    )


def _hourly(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fields: Mapping[str, str],
    stream: bool,
    landed: bool,
    files_per_batch: int | None,
) -> DataFrame:
    reader = (spark.readStream if stream else spark.read).schema(schema).option("mode", "FAILFAST")
    if stream and files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    payloads = reader.json(path)
    if not landed:
        return hourly_rows(payloads, fields)
    when, file = LANDED
    stamped = payloads.select(
        "*",
        F.col("_metadata.file_modification_time").alias(when),
        F.col("_metadata.file_name").alias(file),
    )
    return hourly_rows(stamped, fields, LANDED)


def sorted_out(
    spark: SparkSession, path: str, schema: T.StructType
) -> tuple[DataFrame, DataFrame]:
    """Documents that can be read, and the others as ``(document, reason)``.

    The readers below raise at the first broken document; this is the way to
    land the rest and look at what was refused.
    """
    broken = T.StructField("_broken", T.StringType())
    kind = T.StructType([*schema.fields, broken]).simpleString()
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken.name}
    docs = spark.read.text(path).select("value", F.from_json("value", kind, options).alias("d"))
    reason = F.when(F.col("d._broken").isNotNull(), "not readable").when(F.col("d.city").isNull(), "no city")
    docs = docs.withColumn("reason", reason)
    good = docs.where("reason IS NULL").select(*(f"d.{f.name}" for f in schema.fields))
    return good, docs.where("reason IS NOT NULL").select(F.col("value").alias("document"), "reason")


def read_air(
    spark: SparkSession,
    path: str,
    stream: bool = False,
    landed: bool = False,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Air rows; ``landed`` adds the file's time and name."""
    return _hourly(spark, path, AIR_PAYLOAD, AIR_FIELDS, stream, landed, files_per_batch)


def read_weather(
    spark: SparkSession,
    path: str,
    stream: bool = False,
    landed: bool = False,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Weather rows under their measure names."""
    return _hourly(spark, path, WEATHER_PAYLOAD, WEATHER_FIELDS, stream, landed, files_per_batch)


def write_payloads(hourly: DataFrame, fields: Mapping[str, str], path: str) -> None:
    """Land hourly rows as payload documents, one per city and day.

    A document holds the hours of one day, so its arrays stay short.
    """
    hour = F.struct(
        time_text("time").alias("time"),
        *(F.col(target).alias(source) for source, target in fields.items()),
    )
    days = hourly.groupBy("city", F.to_date("time").alias("_day")).agg(
        F.array_sort(F.collect_list(hour)).alias("_hours")
    )
    arrays = F.struct(*(F.col(f"_hours.{n}").alias(n) for n in ("time", *fields)))
    days.select("city", arrays.alias("hourly")).write.mode("append").json(path)


def read_current(spark: SparkSession, path: str) -> DataFrame:
    """The snapshot payload: one row per document."""
    reader = spark.read.schema(CURRENT_PAYLOAD).option("mode", "FAILFAST")
    rows = reader.json(path).select("current.*")
    return nan_to_null(rows.withColumn("time", parse_time("time")))
