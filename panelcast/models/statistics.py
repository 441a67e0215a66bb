"""Least squares from stored statistics: rows are read once, fits are sums.

For every key and month the number of rows, the means and the centred products of the features and the label are
kept as one row of a keyed table. Centred moments add up without loss of digits, so the moments of any span of
months, and with them the weights with an effect per key, come from these rows alone: a later refit reads the new
month, and the fits of all folds read no month twice. Where a span begins or ends inside a month, the rows of that
month are read as well.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.models.absorb import AbsorbedLinear, solved
from panelcast.operators.split import Folds
from panelcast.session import saved
from panelcast.sources.store import KeyedTable, PanelStore

KEY, KNOWN, MONTH = "key", "known", "month"
"""Rows without a key are a key of their own: ``known`` is false."""


def _pairs(columns: Sequence[str]) -> list[tuple[int, int]]:
    return list(combinations_with_replacement(range(len(columns)), 2))


def moments(rows: DataFrame, columns: Sequence[str], key: str, time: str) -> DataFrame:
    """``key, known, month, n, means, products``: a row per key and month of the rows that have all ``columns``; the
    products are centred, a pair of columns each."""
    places, own = range(len(columns)), [KEY, KNOWN, MONTH]
    full = rows.dropna(subset=list(columns)).select(
        F.coalesce(F.col(key).cast("string"), F.lit("")).alias(KEY), F.col(key).isNotNull().alias(KNOWN),
        F.trunc(time, "month").alias(MONTH), F.array(*(F.col(c).cast("double") for c in columns)).alias("v"),
    )
    # counted from one row of each key and month, so that no digits are lost far from zero
    start = full.groupBy(*own).agg(F.min("v").alias("s"))
    near = full.join(start, own).select(*own, "s", F.zip_with("v", "s", lambda x, y: x - y).alias("d"))
    sums = near.groupBy(*own).agg(
        F.count("*").alias("n"), F.first("s").alias("s"), *(F.sum(F.get("d", F.lit(i))).alias(f"t{i}") for i in places),
        *(F.sum(F.get("d", F.lit(i)) * F.get("d", F.lit(j))).alias(f"p{i}_{j}") for i, j in _pairs(columns)),
    )
    means = F.array(*(F.get("s", F.lit(i)) + F.col(f"t{i}") / F.col("n") for i in places))
    products = F.array(*(F.col(f"p{i}_{j}") - F.col(f"t{i}") * F.col(f"t{j}") / F.col("n") for i, j in _pairs(columns)))
    return sums.select(*own, "n", means.alias("means"), products.alias("products"))


def merged_means(parts: DataFrame) -> DataFrame:
    """``key, known, all_n, all_means``: each key's rows and means over all its ``parts``."""
    each = parts.select(KEY, KNOWN, "n", F.posexplode("means").alias("i", "m")).groupBy(KEY, KNOWN, "i")
    each = each.agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("m")).groupBy(KEY, KNOWN)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"])
    return each.agg(F.max("n").alias("all_n"), ordered.alias("all_means"))


def within(parts: DataFrame, means: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``k, c``: the products of all rows, each centred on its key's mean, a row per pair of columns."""
    first, second = (F.array(*(F.lit(p[side]) for p in _pairs(columns))) for side in (0, 1))
    both = parts.join(means, [KEY, KNOWN]).withColumn("d", F.zip_with("means", "all_means", lambda x, y: x - y))
    moved = F.transform("products", lambda c, k: c + F.col("n") * F.get("d", F.get(first, k)) * F.get("d", F.get(second, k)))
    return both.select(F.posexplode(moved).alias("k", "c")).groupBy("k").agg(F.sum("c").alias("c"))


@dataclass(frozen=True)
class LinearStatistics:
    """The stored moments of ``features`` and ``label``, and fits from them."""

    table: KeyedTable
    features: tuple[str, ...]
    label: str
    key: str = "city"
    time: str = "date"

    @staticmethod
    def in_store(store: PanelStore, name: str, features: Sequence[str], label: str, key: str = "city", time: str = "date") -> LinearStatistics:
        table = store.get_or_create(name, (KEY, KNOWN, MONTH), MONTH)
        return LinearStatistics(table, tuple(features), label, key, time)

    @property
    def columns(self) -> list[str]:
        return [*self.features, self.label]

    def update(self, rows: DataFrame) -> None:
        """Put the moments of ``rows`` in place of those of their keys and months: give whole months."""
        self.table.upsert(moments(rows, self.columns, self.key, self.time))

    def _span(self, before: dt.date | None, rows: DataFrame | None) -> DataFrame:
        if before is None:
            return self.table.read()
        first = before.replace(day=1)
        months = self.table.read(until=first - dt.timedelta(days=1))
        if before == first:
            return months
        if rows is None:
            raise ValueError(f"{before} lies inside a month: its rows are needed")
        inside = rows.where((F.col(self.time) >= F.lit(first)) & (F.col(self.time) < F.lit(before)))
        return months.unionByName(moments(inside, self.columns, self.key, self.time))

    def fit(self, before: dt.date | None = None, rows: DataFrame | None = None) -> AbsorbedLinear:
        """The least-squares fit, with an effect per key, of all rows or those earlier than ``before``.

        ``rows`` is read for the month of ``before`` only."""
        parts = saved(self._span(before, rows), "moments")
        means = saved(merged_means(parts), "means")
        pairs, size = _pairs(self.columns), len(self.columns)
        sums = {r.k: r.c for r in within(parts, means, self.columns).collect()}  # a number for each pair of columns
        gram = np.zeros((size, size))
        for k, (i, j) in enumerate(pairs):
            gram[i, j] = gram[j, i] = sums.get(k, 0.0)
        weights = solved(gram)
        told = F.array(*(F.lit(-w) for w in weights), F.lit(1.0))
        effect = F.aggregate(F.zip_with("all_means", told, lambda m, w: m * w), F.lit(0.0), lambda a, x: a + x)
        effects = saved(means.select(F.when(F.col(KNOWN), F.col(KEY)).alias(self.key), effect.alias("_effect")), "effects")
        unseen = effects.agg(F.avg("_effect")).first()[0]
        return AbsorbedLinear("linear", self.features, self.key, tuple(weights), effects, unseen)

    def fold_fits(self, folds: Folds, rows: DataFrame) -> dict[int, AbsorbedLinear]:
        """Each fold's fit on all earlier rows, as separate fits would give it."""
        return {i: self.fit(folds.starts[i - 1], rows) for i in folds.numbers}
