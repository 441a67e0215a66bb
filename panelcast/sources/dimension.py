"""The key dimension: the sites and where they are."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.spec import KEY_DIMENSION

# Sample sites: name, latitude, longitude (fixed values).
SITES = (
    ("Lahore", 31.5204, 74.3587),
    ("Karachi", 24.8607, 67.0011),
    ("Islamabad", 33.6844, 73.0479),
    ("Faisalabad", 31.4504, 73.1350),
    ("Peshawar", 34.0151, 71.5249),
)


def key_dimension(
    spark: SparkSession, sites: Iterable[tuple[str, float, float]] = SITES
) -> DataFrame:
    return spark.createDataFrame(list(sites), KEY_DIMENSION)


def with_location(df: DataFrame, sites: DataFrame) -> DataFrame:
    """Attach latitude and longitude. The optimizer broadcasts a dimension whose
    measured size is below its threshold and shuffles a larger one."""
    return df.join(sites, "city", "left")


def site_names(sites: DataFrame) -> DataFrame:
    return sites.select(F.col("city")).distinct()
