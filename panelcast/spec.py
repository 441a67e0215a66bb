"""What a panel is, and the declared schemas of every source."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class PanelSpec:
    """A table with one row per (keys, time).

    ``keys`` name the series, ``time`` is a DATE or TIMESTAMP_NTZ column and
    ``values`` are the measures observed at that time.
    """

    keys: tuple[str, ...]
    time: str
    values: tuple[str, ...]

    @property
    def primary_key(self) -> tuple[str, ...]:
        return (*self.keys, self.time)

    def window(self, *extra_keys: str) -> WindowSpec:
        """Each series in time order."""
        return Window.partitionBy(*self.keys, *extra_keys).orderBy(self.time)

    def latest_first(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy(F.col(self.time).desc())

    def order(self) -> list[Column]:
        return [F.col(c) for c in self.primary_key]

    def at(self, time: str) -> PanelSpec:
        return replace(self, time=time)


AIR_MEASURES = ("pm2_5", "pm10")
WEATHER_MEASURES = ("temperature", "humidity", "wind_speed", "pressure")
MEASURES = (*AIR_MEASURES, *WEATHER_MEASURES)

HOURLY = PanelSpec(("city",), "time", MEASURES)
HOURLY_AIR = PanelSpec(("city",), "time", AIR_MEASURES)
HOURLY_WEATHER = PanelSpec(("city",), "time", WEATHER_MEASURES)
DAILY = PanelSpec(("city",), "date", MEASURES)


def _doubles(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.DoubleType()) for n in names]


def _arrays(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.ArrayType(T.DoubleType())) for n in names]


_CITY = T.StructField("city", T.StringType())
_TEXT_TIME = T.StructField("time", T.StringType())
_TEXT_TIMES = T.StructField("time", T.ArrayType(T.StringType()))

# Payload field name -> measure name (fixed values).
AIR_FIELDS = {"pm2_5": "pm2_5", "pm10": "pm10"}
WEATHER_FIELDS = {
    "temperature_2m": "temperature",
    "relative_humidity_2m": "humidity",
    "wind_speed_10m": "wind_speed",
    "surface_pressure": "pressure",
}

AIR_PAYLOAD = T.StructType(
    [_CITY, T.StructField("hourly", T.StructType([_TEXT_TIMES, *_arrays(*AIR_FIELDS)]))]
)
WEATHER_PAYLOAD = T.StructType(
    [_CITY, T.StructField("hourly", T.StructType([_TEXT_TIMES, *_arrays(*WEATHER_FIELDS)]))]
)
CURRENT_PAYLOAD = T.StructType(
    [T.StructField("current", T.StructType([_TEXT_TIME, *_doubles("pm10", "pm2_5")]))]
)

# File layouts. The historical air file spells its columns PM10 and PM2.5.
AIR_CSV = T.StructType([_TEXT_TIME, *_doubles("PM10", "PM2.5")])
WEATHER_CSV = T.StructType([_TEXT_TIME, *_doubles(*WEATHER_MEASURES)])
DAILY_CSV = T.StructType([T.StructField("date", T.DateType()), *_doubles(*MEASURES), _CITY])

KEY_DIMENSION = T.StructType([_CITY, *_doubles("lat", "lon")])
