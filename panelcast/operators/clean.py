"""Row filters by key, time and completeness, and bounded looks at a table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.calendar import day_literal, midnight
from panelcast.spec import PanelSpec


def for_key(df: DataFrame, **key: object) -> DataFrame:
    for name, value in key.items():
        df = df.where(F.col(name) == F.lit(value))
    return df


def observed_hours(
    df: DataFrame, as_of: dt.date | dt.datetime | str, time: str = "time", strict: bool = False
) -> DataFrame:
    """Drop forecast hours. By default all hours of the as-of day stay, with
    ``strict`` only those up to the as-of moment itself."""
    if strict:
        moment = as_of if isinstance(as_of, str) else as_of.isoformat()
        return df.where(F.col(time) <= F.lit(moment).cast("timestamp_ntz"))
    return df.where(F.col(time) < midnight(day_literal(as_of), plus_days=1))


def up_to_day(df: DataFrame, as_of: dt.date | str, date: str = "date") -> DataFrame:
    return df.where(F.col(date) <= F.lit(day_literal(as_of)))


def trailing_days(
    df: DataFrame, days: int = 15, date: str = "date", keys: Sequence[str] = ()
) -> DataFrame:
    """Rows at most ``days`` before the last date of the table.

    The last date is fetched first, as one value, so that the bound is a
    literal and prunes files. With ``keys`` each series has its own last date.
    """
    if keys:
        last = df.groupBy(*keys).agg(F.max(date).alias("_last"))
        return (
            df.join(last, list(keys)).where(F.col(date) >= F.date_sub("_last", days)).drop("_last")
        )
    last_day = df.agg(F.max(date)).first()[0]
    if last_day is None:
        return df.where(F.lit(False))
    return df.where(F.col(date) >= F.lit(last_day - dt.timedelta(days=days)))


def complete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with no NULL in ``columns``, or in any column."""
    return df.dropna("any", subset=None if columns is None else list(columns))


def gap_filled(df: DataFrame, spec: PanelSpec, step: str = "1 DAY") -> DataFrame:
    """A row for every step between a series' first and last time; ``_filled`` marks the added ones.

    Added rows hold their series and time, all else is NULL. A window that counts rows then counts
    steps. Rows without a key are a series, rows without a time and repeated times stay as they are.
    The next time comes from the window that ``with_windows`` sorts by, so the two share a shuffle.
    """
    kind = df.schema[spec.time].dataType
    time, width = F.col(spec.time), F.expr(f"INTERVAL {step}")
    following = F.lead(time).over(spec.window())
    last = F.greatest(time, (following - width).cast(kind))
    steps = df.withColumn("_last", last)
    steps = steps.select("*", F.posexplode_outer(F.sequence(time, "_last", width)).alias("_step", "_time"))
    filled = F.coalesce(F.col("_step") > 0, F.lit(False))
    columns = {c: F.col(c) if c in spec.keys else F.when(~filled, F.col(c)).alias(c) for c in df.columns}
    columns[spec.time] = F.col("_time").alias(spec.time)
    return steps.select(*columns.values(), filled.alias("_filled"))


def tagged(df: DataFrame, **constants: object) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def sorted_panel(df: DataFrame, spec: PanelSpec) -> DataFrame:
    return df.orderBy(*spec.order())


def first_rows(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def last_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    return df.orderBy(*(F.col(c).desc() for c in order)).limit(n)


def sample_rows(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """At most ``n`` rows, picked by a seeded hash of their key.

    The pick does not depend on how the rows are partitioned, nor on the engine: it goes by the MD5 of the
    key's columns and the seed as text, parted by bars.
    """
    pick = F.md5(F.concat_ws("|", *(F.col(k).cast("string") for k in keys), F.lit(seed).cast("string")))
    return df.orderBy(pick, *keys).limit(n)
