"""Sources, sinks and streams as queries: write the sample panel out, read it back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.calendar import time_text
from panelcast.operators import reshape, windows
from panelcast.operators.summaries import SummaryTable
from panelcast.plans import features, ingest
from panelcast.plans.sample_queries import PANEL_AS_OF, H, P, W, rounded
from panelcast.session import fresh_folder
from panelcast.sources import dimension, files, payloads, sample
from panelcast.sources.clustered import ClusteredTable
from panelcast.sources.store import PanelStore
from panelcast.spec import AIR_FIELDS, AIR_MEASURES, AIR_PAYLOAD, DAILY, HOURLY_AIR, WEATHER_FIELDS
from panelcast.streaming.daily import start_daily_mean
from panelcast.streaming.refresh import start_refresh


def _land_air(spark, sf) -> str:
    path = f"{fresh_folder(spark, 'landing')}/air"
    payloads.write_payloads(H(spark, sf), AIR_FIELDS, path)
    return path


def _land_weather(spark, sf) -> str:
    path = f"{fresh_folder(spark, 'landing')}/weather"
    payloads.write_payloads(W(spark, sf), WEATHER_FIELDS, path)
    return path


def payload_air(spark, sf):
    return rounded(payloads.read_air(spark, _land_air(spark, sf)))


def payload_weather(spark, sf):
    return rounded(payloads.read_weather(spark, _land_weather(spark, sf)))


def payload_current(spark, sf):
    path = fresh_folder(spark, "current")
    latest = windows.latest_rows(H(spark, sf), HOURLY_AIR).select(
        F.struct(time_text("time").alias("time"), "pm10", "pm2_5").alias("current")
    )
    latest.write.json(path)
    return rounded(payloads.read_current(spark, path))


def csv_round_trip(spark, sf):
    path = fresh_folder(spark, "csv")
    columns = ("date", *DAILY.values, "city")
    files.write_csv(P(spark, sf).select(*columns), path)
    return rounded(files.read_daily_csv(spark, path))


def merged_csv(spark, sf):
    """The two historical files, written, read and joined on time per key."""
    root = fresh_folder(spark, "csv")
    text = time_text("time").alias("time")
    air = H(spark, sf).groupBy("time").agg(F.avg("pm10").alias("PM10"), F.avg("pm2_5").alias("PM2.5"))
    files.write_csv(air.select(text, "PM10", F.col("`PM2.5`")), f"{root}/air")
    weather = W(spark, sf).groupBy("time").agg(
        *(F.avg(m).alias(m) for m in ("temperature", "humidity", "wind_speed", "pressure"))
    )
    files.write_csv(weather.withColumn("time", text), f"{root}/weather")
    return rounded(
        files.read_air_csv(spark, f"{root}/air").join(
            files.read_weather_csv(spark, f"{root}/weather"), "time"
        )
    )


def key_locations(spark, sf):
    """A key dimension made of the nations, attached to customers per nation."""
    sites = sample.table(spark, sf, "nation").select(
        F.col("n_name").alias("city"),
        (F.col("n_nationkey") * 1.5).alias("lat"),
        (F.col("n_regionkey") * 2.5).alias("lon"),
        "n_nationkey",
    )
    customers = sample.table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(
        F.count(F.lit(1)).alias("n")
    )
    panel = customers.join(sites.select("n_nationkey", "city"), "n_nationkey").select("city", "n")
    return rounded(dimension.with_location(panel, sites.drop("n_nationkey")))


def stored_tables(spark, sf):
    """Two versioned tables: their catalog rows and how many rows each holds.

    The second is read through a fallback, as it has never been written.
    """
    store = PanelStore(spark, fresh_folder(spark, "store"))
    daily = ingest.daily_table(store)
    daily.upsert(P(spark, sf))
    ingest.feature_table(store, version=2)

    def rows(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("name", F.lit(name))

    counts = rows(store.read("daily_measures"), "daily_measures").unionByName(
        rows(store.read("daily_features", 2, fallback=daily.read), "daily_features")
    )
    return store.tables().join(counts, "name").select(
        "name", F.col("version").cast("bigint").alias("version"),
        F.array_join("primary_key", ",").alias("primary_key"), "event_time", "rows",
    )


def stored_features(spark, sf):
    """The feature table as the store keeps it, unlabelled newest rows included."""
    store = PanelStore(spark, fresh_folder(spark, "store"))
    ingest.daily_table(store).upsert(P(spark, sf))
    return rounded(ingest.refresh_features(store).read())


def stored_trailing_window(spark, sf):
    store = PanelStore(spark, fresh_folder(spark, "store"))
    table = ingest.daily_table(store)
    table.upsert(P(spark, sf))
    return rounded(table.trailing(until=PANEL_AS_OF))


def _silent(rows: DataFrame) -> DataFrame:
    """One key falls silent years before the others."""
    return rows.where((F.col("city") != "5-LOW") | (F.col("date") < F.lit(dt.date(1998, 3, 1))))


def trailing_of_silent_keys(spark, sf):
    """Every key's last 15 days, however long ago, found by the tracked last days."""
    table = ingest.daily_table(PanelStore(spark, fresh_folder(spark, "store")))
    rows, half = _silent(P(spark, sf)), F.lit(dt.date(1999, 1, 1))
    table.upsert(rows.where(F.col("date") < half))
    table.track_latest()
    table.upsert(rows.where(F.col("date") >= half))
    return rounded(table.trailing_per_key(15))


def changed_features(spark, sf):
    """The feature table after one key's week was corrected: only the rows that it reaches are recomputed."""
    store = PanelStore(spark, fresh_folder(spark, "store"))
    daily, rows = ingest.daily_table(store), P(spark, sf)
    daily.upsert(rows)
    ingest.refresh_features(store)
    week = rows.where(F.col("date").between(dt.date(2001, 3, 1), dt.date(2001, 3, 7)))
    corrected = F.when(F.col("city") == "2-HIGH", F.col("pm2_5") + 1).otherwise(F.col("pm2_5"))
    changes = daily.upsert_changes(week.withColumn("pm2_5", corrected))
    return rounded(ingest.refresh_changed(store, changes).read())


def clustered_features(spark, sf):
    """All features from a table clustered by key, written in two overlapping steps: its windows need no shuffle."""
    table = ClusteredTable(spark, f"panel_{uuid.uuid4().hex}", DAILY.keys, DAILY.time, 8)
    rows = P(spark, sf)
    table.create(rows.where(F.col("date") <= F.lit(dt.date(2001, 6, 30))).withColumn("pm2_5", F.col("pm2_5") * 2))
    table.upsert(rows)
    return rounded(features.training_rows(features.daily_features(table.read())))


def sketched_profile(spark, sf):
    """A year's profile from monthly summaries; ``near`` says that every quartile's rank is within the sketch's error."""
    kept = SummaryTable.in_store(PanelStore(spark, fresh_folder(spark, "store")), "summaries", AIR_MEASURES)
    rows, half = P(spark, sf), F.lit(dt.date(2000, 7, 1))
    for span in (F.col("date") < half, F.col("date") >= half):
        kept.update(rows.where(span))
    found = kept.profile(dt.date(2000, 1, 1), dt.date(2000, 12, 31))
    year = rows.where(F.col("date").between(dt.date(2000, 1, 1), dt.date(2000, 12, 31)))
    values = year.select(*(F.col(c) for c in AIR_MEASURES)).unpivot([], list(AIR_MEASURES), "column", "value")

    def near(name: str, q: float):
        low, high = (F.avg(test.cast("double")) for test in (F.col("value") < F.col(name), F.col("value") <= F.col(name)))
        return (low - F.max("rank_error") <= q) & (high + F.max("rank_error") >= q)

    held = values.join(found, "column").groupBy("column").agg(
        *(F.round(F.first(c), 6).alias(c) for c in ("n", "nulls", "mean", "std", "min", "max")),
        (near("p25", 0.25) & near("p50", 0.5) & near("p75", 0.75)).alias("near"),
    )
    return held.select("column", "n", "nulls", "mean", "std", "min", "max", "near")


def aligned_columns(spark, sf):
    """The hourly feed under the daily panel's columns, absent ones filled."""
    hours = H(spark, sf).withColumn("date", F.to_date("time"))
    return rounded(reshape.align_columns(hours, ["city", "time", "pm2_5", "humidity", "pressure"]))


def stream_refresh(spark, sf):
    """Both landed feeds through the streaming refresh, a few files at a time."""
    air, weather = _land_air(spark, sf), _land_weather(spark, sf)
    store = PanelStore(spark, fresh_folder(spark, "store"))
    start_refresh(
        spark, air, weather, store, fresh_folder(spark, "checkpoint"), files_per_batch=4
    ).awaitTermination()
    return rounded(store.read("daily_measures"))


def stream_daily_mean(spark, sf):
    air = _land_air(spark, sf)
    store = PanelStore(spark, fresh_folder(spark, "store"))
    # a table of its own: it has no weather
    table = store.get_or_create("daily_air", ("city", "date"), "date")
    hours = payloads.read_air(spark, air, stream=True)
    start_daily_mean(
        hours, AIR_MEASURES, table, fresh_folder(spark, "checkpoint")
    ).awaitTermination()
    return rounded(table.read())


def _landed_twice(spark, sf, once: bool) -> DataFrame:
    """Daily means of a stream in which every hour lands again, higher."""
    air = _land_air(spark, sf)
    store = PanelStore(spark, fresh_folder(spark, "store"))
    table = store.get_or_create("daily_air", ("city", "date"), "date")
    checkpoint = fresh_folder(spark, "checkpoint")
    copies = H(spark, sf).withColumns({m: F.col(m) + 100 for m in AIR_MEASURES})
    for late in (None, copies):
        if late is not None:
            payloads.write_payloads(late, AIR_FIELDS, air)
        hours = payloads.read_air(spark, air, stream=True)
        start_daily_mean(hours, AIR_MEASURES, table, checkpoint, once=once).awaitTermination()
    return rounded(table.read())


def stream_late_hours(spark, sf):
    """Days the watermark has closed don't count the copies; open days count both arrivals."""
    return _landed_twice(spark, sf, once=False)


def stream_repeated_hours(spark, sf):
    """Every hour counts once, as it arrived first: the same days as without the copies."""
    return _landed_twice(spark, sf, once=True)


def stored_features_step(spark, sf):
    """The feature table after most days, then after the rest, recomputed from the first new day."""
    store = PanelStore(spark, fresh_folder(spark, "store"))
    rows, since = P(spark, sf), dt.date(2001, 5, 12)
    daily = ingest.daily_table(store)
    daily.upsert(rows.where(F.col("date") < F.lit(since)))
    ingest.refresh_features(store)
    daily.upsert(rows.where(F.col("date") >= F.lit(since)))
    return rounded(ingest.refresh_features(store, since=since).read())


def landing_check(spark, sf):
    """Documents read and refused: those of one city are cut short, another's lack the city."""
    air = _land_air(spark, sf)
    text = spark.read.text(air)
    cut = F.col("value").contains('"city":"click"')
    nameless = F.col("value").contains('"city":"view"')
    changed = F.when(cut, F.expr("left(value, length(value) - 9)")).when(
        nameless, F.replace("value", F.lit('"city":"view",'), F.lit(""))
    ).otherwise(F.col("value"))
    path = fresh_folder(spark, "landing")
    text.select(changed.alias("value")).write.text(path)
    good, bad = payloads.sorted_out(spark, path, AIR_PAYLOAD)
    read = good.agg(F.count(F.lit(1)).alias("documents"), F.sum(F.size("hourly.time")).alias("hours"))
    refused = bad.groupBy("reason").agg(F.count(F.lit(1)).alias("documents"))
    return read.withColumn("outcome", F.lit("read")).unionByName(
        refused.withColumnRenamed("reason", "outcome"), allowMissingColumns=True
    )


def upsert_empty_first(spark, sf):
    """A first run over an empty window, then all rows."""
    table = ingest.daily_table(PanelStore(spark, fresh_folder(spark, "store")))
    rows = P(spark, sf)
    table.upsert(rows.where(F.lit(False)))
    before = table.read().count()
    table.upsert(rows)
    return rounded(table.read()).withColumn("before", F.lit(before).cast("bigint"))


def upsert_new_column(spark, sf):
    """Earlier rows lack a column that is declared later; every read shows it."""
    table = ingest.daily_table(PanelStore(spark, fresh_folder(spark, "store")))
    rows, cut = P(spark, sf), dt.date(2001, 6, 30)
    table.upsert(rows.where(F.col("date") <= F.lit(cut)).drop("pressure"))
    table.add_columns("pressure double")
    table.upsert(rows.where(F.col("date") > F.lit(cut)))
    late = table.read(since=dt.date(2001, 6, 1))
    return rounded(late)


QUERIES = {
    f.__name__: f
    for f in (
        landing_check, upsert_empty_first, upsert_new_column, payload_air, payload_weather, payload_current, csv_round_trip, merged_csv, key_locations,
        stored_tables, stored_features, stored_trailing_window, aligned_columns, stream_refresh, stream_daily_mean,
        stream_late_hours, stream_repeated_hours, stored_features_step, trailing_of_silent_keys, changed_features,
        clustered_features, sketched_profile,
    )
}
