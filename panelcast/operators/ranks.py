"""Exact order statistics of a column of any size.

A global sort or row number would need one task to see every row, and Spark's
``percentile`` keeps all distinct values of a group in one buffer. Here the
rank is closed in on instead: an approximate quantile gives two values around
it, one counting pass tells exactly where the rank lies relative to them, and
the search goes on between them until few distinct values are left. Every pass
is a map-side aggregate; the driver sees a handful of numbers, and in the end at
most about ``SMALL`` (value, count) pairs, which all ranks share. A column with few
distinct values, such as dates, skips the search however many rows there are.

Every pass reads the input again: give a stored table, or ``session.saved`` columns.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.functions.calendar import literal

SMALL = 50_000
ACCURACY = 10_000


@dataclass
class _Search:
    """The rank wanted among the values strictly between two bounds."""

    column: str
    rank: int
    count: int
    distinct: int
    data_type: T.DataType
    above: Any = None
    below: Any = None
    answer: Any = None

    def literal(self, bound: Any) -> Column:
        return literal(bound, self.data_type)

    def candidates(self) -> Column:
        value = F.col(self.column)
        test = value.isNotNull()
        if self.above is not None:
            test = test & (value > self.literal(self.above))
        if self.below is not None:
            test = test & (value < self.literal(self.below))
        return F.when(test, value)

    def is_small(self, small: int) -> bool:
        return min(self.count, self.distinct) <= small


@dataclass(frozen=True)
class Tally:
    """How many values a column has, and about how many different ones."""

    count: int
    distinct: int


def tally_columns(columns: Sequence[str]) -> list[Column]:
    """Aggregates that ``read_tallies`` reads, to go along with others in one job."""
    return [
        F.struct(F.count(c).alias("n"), F.approx_count_distinct(c, 0.05).alias("d")).alias(
            f"_tally_{c}"
        )
        for c in columns
    ]


def read_tallies(row: Row, columns: Sequence[str]) -> dict[str, Tally]:
    # A fifth more than estimated, four times the estimate's standard error.
    return {c: Tally(row[f"_tally_{c}"].n, int(row[f"_tally_{c}"].d * 1.2) + 1) for c in columns}


def count_values(df: DataFrame, columns: Sequence[str]) -> dict[str, Tally]:
    return read_tallies(df.agg(*tally_columns(columns)).first(), columns)


def order_statistics(
    df: DataFrame,
    ranks: Mapping[str, Sequence[int]],
    small: int = SMALL,
    tallies: Mapping[str, Tally] | None = None,
) -> dict[str, list[Any]]:
    """For each column the values at the given zero-based ranks, NULLs left out.

    A rank past the end gives None. At most about ``small`` values come to the driver, or one
    per rank where there are more ranks than that.
    """
    tallies = tallies or count_values(df, list(ranks))
    searches = [
        _Search(column, rank, tallies[column].count, tallies[column].distinct, df.schema[column].dataType)
        for column, wanted in ranks.items()
        for rank in wanted
    ]
    valid = [s for s in searches if 0 <= s.rank < s.count]
    while open_ := _too_large([s for s in valid if s.answer is None], small):
        _narrow(df, open_)
    _finish(df, [s for s in valid if s.answer is None])
    found: dict[str, list[Any]] = {column: [] for column in ranks}
    for s in searches:
        found[s.column].append(s.answer)
    return found


def _too_large(searches: list[_Search], small: int) -> list[_Search]:
    """The searches to narrow before all intervals together have at most ``small`` values."""
    groups = _intervals(searches)
    share = max(1, small // max(1, len(groups)))
    return [s for members in groups for s in members if not s.is_small(share)]


def _intervals(searches: list[_Search]) -> list[list[_Search]]:
    """Searches that still look between the same bounds of the same column."""
    groups: dict[tuple, list[_Search]] = {}
    for s in searches:
        groups.setdefault((s.column, s.above, s.below), []).append(s)
    return list(groups.values())


def _narrow(df: DataFrame, searches: list[_Search]) -> None:
    """Two passes: approximate quantiles around each rank, then exact counts at them."""
    groups = _intervals(searches)
    slack = 2.0 / ACCURACY
    around = []
    for i, members in enumerate(groups):
        shares = [(s.rank + 0.5) / s.count for s in members]
        points = [p for x in shares for p in (max(0.0, x - slack), min(1.0, x + slack))]
        around.append(
            F.percentile_approx(members[0].candidates(), points, ACCURACY).alias(f"b{i}")
        )
    brackets = df.agg(*around).first()

    tallies = []
    for i, members in enumerate(groups):
        value = members[0].candidates()
        for j, bound in enumerate(sorted(set(brackets[f"b{i}"]))):
            at = members[0].literal(bound)
            tallies.append(F.count_if(value < at).alias(f"lt{i}_{j}"))
            tallies.append(F.count_if(value == at).alias(f"eq{i}_{j}"))
    tally = df.agg(*tallies).first()

    for i, members in enumerate(groups):
        bounds = sorted(set(brackets[f"b{i}"]))
        for s in members:
            _place(s, [(b, tally[f"lt{i}_{j}"], tally[f"eq{i}_{j}"]) for j, b in enumerate(bounds)])


def _place(search: _Search, bounds: list[tuple[Any, int, int]]) -> None:
    """Move a search between the bounds, given as (value, rows below, rows equal)."""
    before, total = 0, search.count
    for value, lower, equal in bounds:
        if search.rank < lower:
            search.below, total = value, lower
            break
        if search.rank < lower + equal:
            search.answer = value
            return
        search.above, before = value, lower + equal
    search.rank, search.count = search.rank - before, total - before


def _finish(df: DataFrame, searches: list[_Search]) -> None:
    """Few candidates are left per search: read off the ranks from their counts.

    All columns of one type are counted in one job.
    """
    by_type: dict[str, list[_Search]] = {}
    for s in searches:
        by_type.setdefault(s.data_type.simpleString(), []).append(s)
    for alike in by_type.values():
        groups = _intervals(alike)
        values = F.array(*(members[0].candidates() for members in groups))
        pairs = (
            df.select(F.posexplode(values).alias("place", "value"))
            .where(F.col("value").isNotNull())
            .groupBy("place", "value")
            .agg(F.count(F.lit(1)).alias("n"))
            .collect()
        )
        pairs.sort(key=lambda p: (p.place, p.value))
        for place, members in enumerate(groups):
            _read_off([p for p in pairs if p.place == place], members)


def _read_off(pairs: list[Row], searches: list[_Search]) -> None:
    for s in searches:
        seen = 0
        for pair in pairs:
            seen += pair.n
            if s.rank < seen:
                s.answer = pair.value
                break


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    shares: Sequence[float],
    small: int = SMALL,
    tallies: Mapping[str, Tally] | None = None,
) -> dict[str, list[float | None]]:
    """Exact quantiles, linear between the two neighbouring values."""
    tallies = tallies or count_values(df, columns)
    ranks, places = {}, {}
    for column in columns:
        spots = [(tallies[column].count - 1) * q for q in shares]
        places[column] = spots
        ranks[column] = [r for s in spots for r in (math.floor(s), math.ceil(s))]
    values = order_statistics(df, ranks, small, tallies)
    result: dict[str, list[float | None]] = {}
    for column in columns:
        pairs = zip(values[column][::2], values[column][1::2], places[column], strict=True)
        result[column] = [
            None if low is None else low + (high - low) * (spot - math.floor(spot))
            for low, high, spot in pairs
        ]
    return result
