"""Lags, leads and trailing means: row-based, per series.

``with_windows`` adds everything a recipe asks for in one projection, so Spark
plans a single Window over a single sort. Windows count rows, not days: where a
day is missing the previous row is an older day.

A plain window puts a whole series into one task. That is bounded for daily
panels (366 rows a year and key) but not for finer grains, where one key may
hold a large part of all rows. ``with_windows(..., chunk=...)`` cuts each series
into time chunks, so a series of any length is spread over many tasks, and looks
at the rows near the chunks' ends once more together.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from panelcast.spec import PanelSpec

CHUNK = "_chunk"
PLACE = "_place"
ENDS = "_ends"


@dataclass(frozen=True)
class WindowRecipe:
    """Which windows to build over ``value``.

    Names are templates over ``n``. Trailing means leave the current row out
    unless ``include_current``.
    """

    value: str = "pm2_5"
    lags: tuple[int, ...] = ()
    trailing: tuple[int, ...] = ()
    leads: tuple[int, ...] = ()
    include_current: bool = False
    lag_name: str = "pm25_lag_{n}"
    trailing_name: str = "pm25_rolling_{n}"
    lead_name: str = "target_{n}d"

    @property
    def rows_before(self) -> int:
        means = max(self.trailing, default=0) - int(self.include_current)
        return max(0, means, max(self.lags, default=0))

    @property
    def rows_after(self) -> int:
        return max(self.leads, default=0)

    def names(self) -> list[str]:
        return [
            *(self.lag_name.format(n=n) for n in self.lags),
            *(self.trailing_name.format(n=n) for n in self.trailing),
            *(self.lead_name.format(n=n) for n in self.leads),
        ]


DAILY_RECIPE = WindowRecipe(lags=(1, 3, 7), trailing=(3, 7), leads=(1, 2, 3))
HOURLY_RECIPE = WindowRecipe(
    lags=(1, 24),
    trailing=(3, 24),
    leads=(24, 48, 72),
    include_current=True,
    lead_name="target_{n}h",
)


def trailing_mean(
    value: str, n: int, window: WindowSpec, include_current: bool = False
) -> Column:
    """Mean of the last ``n`` rows, NULL unless all ``n`` values are there."""
    frame = window.rowsBetween(-(n - 1), 0) if include_current else window.rowsBetween(-n, -1)
    return F.when(F.count(value).over(frame) == n, F.avg(value).over(frame))


def window_columns(recipe: WindowRecipe, window: WindowSpec) -> dict[str, Column]:
    value = recipe.value
    return {
        **{recipe.lag_name.format(n=n): F.lag(value, n).over(window) for n in recipe.lags},
        **{
            recipe.trailing_name.format(n=n): trailing_mean(
                value, n, window, recipe.include_current
            )
            for n in recipe.trailing
        },
        **{recipe.lead_name.format(n=n): F.lead(value, n).over(window) for n in recipe.leads},
    }


def with_windows(
    df: DataFrame, spec: PanelSpec, recipe: WindowRecipe, chunk: str | None = None
) -> DataFrame:
    """``df`` with the recipe's columns.

    ``chunk`` is a ``date_trunc`` unit such as ``"month"``: the span of time
    whose rows of one series a single task may hold.
    """
    if chunk is None:
        return df.withColumns(window_columns(recipe, spec.window()))
    reach = recipe.rows_before + recipe.rows_after
    if not reach:
        return _in_chunks(df, spec, chunk).withColumns(window_columns(recipe, spec.window(CHUNK))).drop(CHUNK)
    rows = with_ends(df, spec, recipe.rows_before, recipe.rows_after, chunk)
    part = Window.partitionBy(*spec.keys, ENDS, CHUNK).orderBy(spec.time, PLACE)
    return rows.withColumns(window_columns(recipe, part)).where("_own").drop(CHUNK, PLACE, ENDS, "_own")


def _in_chunks(df: DataFrame, spec: PanelSpec, chunk: str) -> DataFrame:
    return df.withColumn(CHUNK, F.date_trunc(chunk, F.col(spec.time).cast("timestamp")))


def with_ends(df: DataFrame, spec: PanelSpec, before: int, after: int, chunk: str) -> DataFrame:
    """Every row in its chunk, and copies of the rows near the ends of all chunks of a series.

    A row whose windows stay inside its chunk (``before`` rows ahead of it, ``after``
    behind it) is right there. The others are right among the copies: these hold the
    first and last ``before + after`` rows of each chunk, hence every row such a window
    reaches without a gap, however sparse the chunks. ``_own`` marks the one of the two that
    counts. Copies have no chunk: the ends of one series meet in one task, at most
    ``2 * (before + after)`` rows a chunk. ``_place`` is a row's number in its chunk, so that rows
    of one time keep one order. The input is read once and shuffled by chunk once.
    """
    own = Window.partitionBy(*spec.keys, CHUNK)
    size, place = F.count(F.lit(1)).over(own), F.row_number().over(own.orderBy(spec.time))
    rows = _in_chunks(df, spec, chunk).withColumns({PLACE: place, "_size": size})
    behind = F.col("_size") - F.col(PLACE)
    inside = (F.col(PLACE) > before) & (behind >= after)
    near = (F.col(PLACE) <= before + after) | (behind < before + after)
    copies = F.when(near, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    return (
        rows.withColumn("_inside", inside)
        .withColumn(ENDS, F.explode(copies))
        .withColumns({CHUNK: F.when(~F.col(ENDS), F.col(CHUNK)), "_own": F.col("_inside") != F.col(ENDS)})
        .drop("_size", "_inside")
    )


def latest_rows(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """The last row of every series; each task passes on one row per series."""
    return (
        df.withColumn("_rank", F.row_number().over(spec.latest_first()))
        .where("_rank = 1")
        .drop("_rank")
    )
