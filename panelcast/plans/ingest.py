"""Re-processing a short trailing window of feeds into the daily table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelcast.functions.calendar import day_literal, midnight
from panelcast.operators.clean import observed_hours
from panelcast.operators.daily import daily_mean_of_feeds
from panelcast.operators.windows import DAILY_RECIPE
from panelcast.plans.features import daily_features, serving_rows
from panelcast.sources.store import KeyedTable, PanelStore
from panelcast.spec import DAILY

# Days re-processed on every run, besides the as-of day (fixed value).
PAST_DAYS = 3


def trailing_hours(
    feed: DataFrame,
    as_of: dt.date | dt.datetime | str,
    past_days: int = PAST_DAYS,
    time: str = "time",
    strict: bool = False,
) -> DataFrame:
    """The hours a run looks at: from ``past_days`` before the as-of day to its end."""
    since = midnight(day_literal(as_of), plus_days=-past_days)
    return observed_hours(feed.where(F.col(time) >= since), as_of, time, strict)


def refreshed_days(
    air: DataFrame,
    weather: DataFrame,
    as_of: dt.date | dt.datetime | str,
    past_days: int = PAST_DAYS,
    strict: bool = False,
) -> DataFrame:
    """Daily means of the trailing window, recomputed from all hours landed so far.

    The time bound is applied to each feed, where it prunes the scan.
    """
    return daily_mean_of_feeds(
        trailing_hours(air, as_of, past_days, strict=strict),
        trailing_hours(weather, as_of, past_days, strict=strict),
    )


def daily_table(store: PanelStore, name: str = "daily_measures", version: int = 1) -> KeyedTable:
    return store.get_or_create(
        name, DAILY.primary_key, DAILY.time, version, "Daily means of air and weather per city"
    )


def feature_table(store: PanelStore, name: str = "daily_features", version: int = 1) -> KeyedTable:
    return store.get_or_create(
        name, DAILY.primary_key, DAILY.time, version, "Lags, trailing means and targets per city"
    )


def refresh(
    table: KeyedTable,
    air: DataFrame,
    weather: DataFrame,
    as_of: dt.date | dt.datetime | str,
    past_days: int = PAST_DAYS,
) -> None:
    """One incremental run: days complete so far replace their earlier versions."""
    table.upsert(refreshed_days(air, weather, as_of, past_days))


def refresh_features(
    store: PanelStore,
    chunk: str | None = None,
    replace: bool = False,
    since: dt.date | None = None,
) -> KeyedTable:
    """Recompute the feature table from the daily table.

    It holds every row with a full history. The newest rows have no label yet:
    serving reads them, training asks for labels. Rows that vanished from the
    daily table stay unless ``replace``. With ``since`` only days from then on have
    changed: just the rows they reach are recomputed, from the folders that hold their history.
    """
    table = feature_table(store)
    daily = store.get("daily_measures")
    if since is not None:
        table.upsert(serving_rows(_changed_features(daily, since, chunk)))
        return table
    rows = serving_rows(daily_features(daily.read(), chunk=chunk))
    if replace:
        table.replace(rows)
    else:
        table.upsert(rows)
    return table


def _changed_features(daily: KeyedTable, since: dt.date, chunk: str | None) -> DataFrame:
    """Features of the rows from ``since`` on, and of those before whose targets reach them."""
    before, after = DAILY_RECIPE.rows_before, DAILY_RECIPE.rows_after
    older = F.col(DAILY.time) < F.lit(since)
    earlier = [p for p in daily.parts() if p < daily.part_of(since)]
    recent = [p for p in daily.parts() if p >= daily.part_of(since)]
    back = 1
    while True:
        rows = daily.read(parts=[*earlier[-back:], *recent])
        # Windows count rows, so how far back they reach is known from the rows alone: look at
        # twice as many folders until every changed key has enough.
        history = rows.groupBy(*DAILY.keys).agg(F.count_if(older).alias("n"), F.count_if(~older).alias("new"))
        least = history.where("new > 0").agg(F.min("n")).first()[0]
        if back >= len(earlier) or least is None or least >= before + after:
            break
        back *= 2
    place = F.row_number().over(DAILY.latest_first())
    newer = F.count_if(~older).over(Window.partitionBy(*DAILY.keys))
    marked = rows.withColumns({"_place": place, "_newer": newer}).where("_newer > 0")
    wanted = marked.where(F.col("_place") <= F.col("_newer") + before + after)
    changed = daily_features(wanted, chunk=chunk).where(F.col("_place") <= F.col("_newer") + after)
    return changed.drop("_place", "_newer")


def refresh_changed(store: PanelStore, changes: DataFrame, chunk: str | None = None) -> KeyedTable:
    """Recompute the features that changed daily rows reach, and no others.

    ``changes`` are primary keys of the daily table, as ``upsert_changes`` gives them. A row's features look
    at the rows of its key up to ``rows_before`` before and ``rows_after`` behind it, so it is recomputed if a changed row is that near.
    """
    table, daily = feature_table(store), store.get("daily_measures")
    span = changes.agg(F.min(DAILY.time).alias("first"), F.max(DAILY.time).alias("last")).first()
    if span.first is None:
        return table
    before, after = DAILY_RECIPE.rows_before, DAILY_RECIPE.rows_after
    reach = before + after
    parts = daily.parts()
    inside = [p for p in parts if daily.part_of(span.first) <= p <= daily.part_of(span.last)]
    earlier = [p for p in parts if p < daily.part_of(span.first)]
    later = [p for p in parts if p > daily.part_of(span.last)]
    keys = changes.groupBy(*DAILY.keys).agg(F.min(DAILY.time).alias("_first"), F.max(DAILY.time).alias("_last"))
    back = 1
    while True:
        rows = daily.read(parts=[*earlier[-back:], *inside, *later[:back]]).join(keys, list(DAILY.keys))
        # windows count rows: look at more folders until every changed key has enough on both sides
        held = rows.groupBy(*DAILY.keys).agg(
            F.count_if(F.col(DAILY.time) < F.col("_first")).alias("n"), F.count_if(F.col(DAILY.time) > F.col("_last")).alias("m")
        )
        least = held.agg(F.min("n").alias("n"), F.min("m").alias("m")).first()
        enough = (back >= len(earlier) or (least.n or 0) >= reach) and (back >= len(later) or (least.m or 0) >= reach)
        if enough:
            break
        back *= 2
    series = Window.partitionBy(*DAILY.keys).orderBy(DAILY.time)
    marked = rows.drop("_first", "_last").join(changes.withColumn("_hit", F.lit(1)), [*DAILY.keys, DAILY.time], "left")
    marked = marked.withColumns({
        "_reached": F.max("_hit").over(series.rowsBetween(-before, after)).isNotNull(),
        "_near": F.max("_hit").over(series.rowsBetween(-reach, reach)).isNotNull(),
    })
    wanted = marked.where("_near").drop("_hit", "_near")
    table.upsert(serving_rows(daily_features(wanted, chunk=chunk).where("_reached").drop("_reached")))
    return table
