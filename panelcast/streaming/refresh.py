"""The incremental refresh as a stream over landed payload files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from panelcast.operators.daily import daily_mean_of_feeds
from panelcast.plans.ingest import PAST_DAYS, daily_table, trailing_hours
from panelcast.sources.payloads import LANDED, read_air, read_weather
from panelcast.sources.store import KeyedTable, PanelStore
from panelcast.spec import HOURLY_AIR, HOURLY_WEATHER, PanelSpec

AIR, WEATHER = "air", "weather"


def landed_feeds(
    spark: SparkSession, air_path: str, weather_path: str, files_per_batch: int | None = None
) -> DataFrame:
    """Both feeds as one stream, told apart by ``feed``."""
    air = read_air(spark, air_path, True, True, files_per_batch)
    weather = read_weather(spark, weather_path, True, True, files_per_batch)
    return air.withColumn("feed", F.lit(AIR)).unionByName(
        weather.withColumn("feed", F.lit(WEATHER)), allowMissingColumns=True
    )


def _raw_table(store: PanelStore, feed: str, spec: PanelSpec) -> KeyedTable:
    return store.get_or_create(
        f"hourly_{feed}", spec.primary_key, spec.time, 1, f"Hourly {feed} as landed", unit="day"
    )


def refresh_batch(
    store: PanelStore,
    as_of: dt.date | dt.datetime | str | None = None,
    past_days: int = PAST_DAYS,
) -> Callable[[DataFrame, int], None]:
    """What to do with each micro-batch.

    New hours replace earlier copies of themselves in the raw tables; then the
    days they touch, and only those, are recomputed from all their hours. A
    stream-to-stream join would hold a day back until the watermark closes it;
    this way a partial day is there at once. Every step replaces rows by key, so
    running a batch again after a failure changes nothing.

    With ``as_of`` hours outside the trailing window are ignored.
    """

    def run(batch: DataFrame, _batch_id: int) -> None:
        if as_of is not None:
            batch = trailing_hours(batch, as_of, past_days)
        batch = batch.persist()
        try:
            _upsert_days(store, batch)
        finally:
            batch.unpersist()

    return run


def _upsert_days(store: PanelStore, batch: DataFrame) -> None:
    day = F.to_date("time").alias("date")
    # One date per day touched, however far apart: an hour that is a year late reads one more folder.
    days = [r.date for r in batch.select(day).distinct().where("date is not null").collect()]
    if not days:
        return
    tables = {
        AIR: (_raw_table(store, AIR, HOURLY_AIR), HOURLY_AIR),
        WEATHER: (_raw_table(store, WEATHER, HOURLY_WEATHER), HOURLY_WEATHER),
    }
    for feed, (table, spec) in tables.items():
        rows = batch.where(F.col("feed") == feed)
        if not rows.isEmpty():
            table.upsert(rows.select(*spec.primary_key, *spec.values, *LANDED), newest=LANDED)
    if not all(table.exists() for table, _ in tables.values()):
        return
    touched = batch.select("city", day).distinct()

    def hours(feed: str) -> DataFrame:
        table = tables[feed][0]
        rows = table.read(parts=[table.part_of(d) for d in days])
        return rows.withColumn("date", F.to_date("time")).join(
            touched, ["city", "date"], "left_semi"
        )

    daily_table(store).upsert(daily_mean_of_feeds(hours(AIR), hours(WEATHER)))


def start_refresh(
    spark: SparkSession,
    air_path: str,
    weather_path: str,
    store: PanelStore,
    checkpoint: str,
    as_of: dt.date | dt.datetime | str | None = None,
    past_days: int = PAST_DAYS,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Process everything landed so far in micro-batches, then stop."""
    return (
        landed_feeds(spark, air_path, weather_path, files_per_batch)
        .writeStream.foreachBatch(refresh_batch(store, as_of, past_days))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
