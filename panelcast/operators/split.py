"""Event-time splits: by dates, by share of rows, and into growing folds.

Every split is a comparison of the time column with literals found beforehand,
so it never depends on row order and needs no window over the whole table.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.functions.calendar import literal
from panelcast.operators.ranks import count_values, order_statistics
from panelcast.session import saved


@dataclass(frozen=True)
class SplitBounds:
    """Train and test ranges, both ends included; None leaves an end open."""

    train_start: dt.date | None
    train_end: dt.date
    test_start: dt.date
    test_end: dt.date | None


def _within(time: str, start: dt.date | None, end: dt.date | None) -> Column:
    test = F.col(time).isNotNull()
    if start is not None:
        test = test & (F.col(time) >= F.lit(start))
    if end is not None:
        test = test & (F.col(time) <= F.lit(end))
    return test


def split_tag(bounds: SplitBounds, time: str = "date") -> Column:
    """``train``, ``test`` or NULL for a row in neither range."""
    return F.when(_within(time, bounds.train_start, bounds.train_end), "train").when(
        _within(time, bounds.test_start, bounds.test_end), "test"
    )


def event_time_split(
    df: DataFrame, bounds: SplitBounds, time: str = "date"
) -> tuple[DataFrame, DataFrame]:
    return (
        df.where(_within(time, bounds.train_start, bounds.train_end)),
        df.where(_within(time, bounds.test_start, bounds.test_end)),
    )


def chronological_cutoff(df: DataFrame, time: str, share: float = 0.8) -> Any:
    """The time of row ``int(n * share)`` in time order: where the test part starts.

    The column is saved first, so that ``df`` is computed once however long the search.
    """
    times = saved(df.select(time), "times")
    tallies = count_values(times, [time])
    rank = int(tallies[time].count * share)
    return order_statistics(times, {time: [rank]}, tallies=tallies)[time][0]


def chronological_tag(df: DataFrame, time: str, share: float = 0.8) -> Column:
    """``train`` for the earliest ``share`` of rows, ``test`` for the rest.

    A series with distinct times splits at exactly ``int(n * share)`` rows. Rows
    of one moment stay together, so in a panel no moment is in both parts.
    """
    cutoff = chronological_cutoff(df, time, share)
    if cutoff is None:
        return F.lit("train")
    cut = literal(cutoff, df.schema[time].dataType)
    return F.when(F.col(time) < cut, "train").otherwise("test")


@dataclass(frozen=True)
class Folds:
    """Growing-window folds: test fold ``i`` holds the times from ``starts[i - 1]``
    up to the next start, and trains on everything earlier."""

    starts: tuple[Any, ...]

    @property
    def numbers(self) -> range:
        return range(1, len(self.starts) + 1)


def expanding_folds(df: DataFrame, time: str = "date", splits: int = 3) -> Folds:
    """Folds over the distinct times, equal in number of times.

    With ``n`` distinct times each test fold has ``t = n // (splits + 1)`` of
    them and the last fold ends with the last time.
    """
    times = saved(df.select(time).distinct(), "times")
    tallies = count_values(times, [time])
    total = tallies[time].count
    size = total // (splits + 1)
    if size == 0:
        raise ValueError(f"{total} distinct times are too few for {splits} folds")
    ranks = [total - (splits - i) * size for i in range(splits)]
    starts = order_statistics(times, {time: ranks}, tallies=tallies)[time]
    return Folds(tuple(starts))


def fold_number(df: DataFrame, folds: Folds, time: str = "date") -> Column:
    """The test fold a row belongs to; 0 for rows that are only ever trained on.

    Fold ``i`` trains on rows numbered below ``i`` and tests on rows numbered ``i``.
    """
    data_type = df.schema[time].dataType
    chain = None
    for i in reversed(folds.numbers):
        test = F.col(time) >= literal(folds.starts[i - 1], data_type)
        chain = F.when(test, F.lit(i)) if chain is None else chain.when(test, F.lit(i))
    return chain.otherwise(F.lit(0))
