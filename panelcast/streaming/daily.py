"""Daily means of one feed as a stream, with a bound on late hours."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from panelcast.sources.store import KeyedTable

LATE_BOUND = "3 days"
DAY_SECONDS = 86_400


def as_instant(time: str) -> Column:
    """A zone-free time as the same clock reading in UTC.

    Watermarks need an instant; going through the session zone would move days.
    """
    days = F.unix_date(F.to_date(time)).cast("bigint") * F.lit(DAY_SECONDS)
    return F.timestamp_seconds(
        days + F.hour(time) * F.lit(3600) + F.minute(time) * F.lit(60) + F.second(time)
    )


def streaming_daily_mean(
    hours: DataFrame,
    measures: Sequence[str],
    late_bound: str = LATE_BOUND,
    key: str | Sequence[str] = "city",
    time: str = "time",
    once: bool = True,
) -> DataFrame:
    """Tumbling one-day means. An hour later than the bound is not counted.

    An hour that arrives again counts once, its first arrival; ``once=False`` counts all arrivals. State is one row of sums per key and
    open day, and the keys and times of the hours that the watermark hasn't passed.
    """
    instants = hours.withColumn(time, as_instant(time)).withWatermark(time, late_bound)
    keys = [key] if isinstance(key, str) else list(key)
    if once:
        instants = instants.dropDuplicatesWithinWatermark([*keys, time])
    days = instants.groupBy(*keys, F.window(time, "1 day").alias("_day")).agg(
        *(F.avg(m).alias(m) for m in measures), F.count(F.lit(1)).alias("n_obs")
    )
    date = F.date_from_unix_date(
        F.floor(F.unix_seconds("_day.start") / F.lit(DAY_SECONDS)).cast("int")
    )
    return days.select(*keys, date.alias("date"), *measures, "n_obs")


def start_daily_mean(
    hours: DataFrame,
    measures: Sequence[str],
    table: KeyedTable,
    checkpoint: str,
    late_bound: str = LATE_BOUND,
    once: bool = True,
) -> StreamingQuery:
    """Keep ``table`` up to date: every batch upserts the days it changed."""

    def upsert(batch: DataFrame, _batch_id: int) -> None:
        table.upsert(batch)

    return (
        streaming_daily_mean(hours, measures, late_bound, once=once)
        .writeStream.outputMode("update")
        .foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
