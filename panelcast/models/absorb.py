"""Least squares with an effect per key, for any number of keys.

A column per key would widen the matrix, and the driver's share of the work,
with every key. Subtracting each key's means from its rows removes the key
effects exactly, so the weights come from a matrix of the features alone, and
each key's effect follows from its means. Forecasts are those of the full
one-hot fit.

The products of the centred rows need no join with the means: they are the
products of all rows less those of the means, each weighted with its key's rows.
So a fit moves a row of sums per key and task, and no rows. Where the keys
explain nearly all of a column, or features are nearly tied, that difference
would lose digits; then the rows do meet their means.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.session import saved

# The least share of a column's squares that lies inside the keys: below it, a difference would lose more than two digits.
INSIDE = 0.01
# The least eigenvalue of the features' correlations inside the keys: below it they are nearly tied, and lost digits would show.
TIED = 1e-6
# Sums of one pass: a plan of many more takes longer to compile than to run.
SUMS = 1_000


@dataclass(frozen=True)
class AbsorbedLinear:
    """Weights for the features, and a stored table of key effects."""

    name: str
    features: tuple[str, ...]
    key: str
    weights: tuple[float, ...]
    effects: DataFrame
    unseen: float
    """The effect of a key not seen in training: the mean over keys."""

    form = "absorbed"

    def score(self, df: DataFrame, prediction: str = "prediction") -> DataFrame:
        """One more column; keys find their effect by a join whose strategy
        follows the measured size of the effects table."""
        known = self.effects.withColumnRenamed(self.key, "_effect_key")
        linear = F.coalesce(F.col("_effect"), F.lit(self.unseen))
        for feature, weight in zip(self.features, self.weights, strict=True):
            linear = linear + F.col(feature) * F.lit(weight)
        joined = df.join(known, df[self.key].eqNullSafe(known["_effect_key"]), "left")
        return joined.select(*(df[c] for c in df.columns), linear.alias(prediction))

    def save(self, path: str) -> None:
        self.effects.write.mode("overwrite").parquet(f"{path}/effects")
        row = [(list(self.weights), self.unseen)]
        self.effects.sparkSession.createDataFrame(
            row, "weights array<double>, unseen double"
        ).write.mode("overwrite").parquet(f"{path}/weights")

    @staticmethod
    def load(
        spark: SparkSession, path: str, name: str, features: Sequence[str], key: str
    ) -> AbsorbedLinear:
        row = spark.read.parquet(f"{path}/weights").first()
        effects = spark.read.parquet(f"{path}/effects")
        return AbsorbedLinear(name, tuple(features), key, tuple(row.weights), effects, row.unseen)


def products(rows: DataFrame, columns: Sequence[Column]) -> np.ndarray:
    """Sums of the products of each two columns. Nothing is moved but sums, ``SUMS`` of them in a pass."""
    rows = rows.select(*(c.alias(f"x{i}") for i, c in enumerate(columns)))
    pairs = list(combinations_with_replacement(range(len(columns)), 2))
    gram = np.zeros((len(columns), len(columns)))
    for k in range(0, len(pairs), SUMS):
        some = pairs[k : k + SUMS]
        found = rows.agg(*(F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"s{i}_{j}") for i, j in some)).first()
        for (i, j), value in zip(some, found, strict=True):
            gram[i, j] = gram[j, i] = value
    return gram


def _scaled(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    scale = np.sqrt(np.maximum(np.diag(gram)[:-1], 1e-300))
    return scale, gram[:-1, :-1] / np.outer(scale, scale)


def solved(gram: np.ndarray) -> list[float]:
    """Least-squares weights from the products of centred columns, the label's last."""
    scale, scaled = _scaled(gram)
    return (np.linalg.lstsq(scaled, gram[:-1, -1] / scale, rcond=None)[0] / scale).tolist()


def centred_products(train: DataFrame, means: DataFrame, columns: Sequence[str], key: str) -> np.ndarray:
    """The products of ``train``'s columns, each row centred on its key's mean.

    ``means`` has a row per key: ``_mean_key``, ``_rows``, ``_unfit`` and ``_mean_...``."""
    n, unfit, *usual = means.agg(
        F.sum("_rows"), F.sum("_unfit"), *(F.sum(F.col(f"_mean_{c}") * F.col("_rows")) / F.sum("_rows") for c in columns)
    ).first()
    if not n:
        raise ValueError("no rows to fit")
    if unfit:
        raise ValueError(f"{unfit} of {n} rows lack a finite value in one of {', '.join(columns)}")
    centre = [F.lit(m) for m in usual]
    every = products(train, [F.col(c).cast("double") - m for c, m in zip(columns, centre, strict=True)])
    between = products(means, [(F.col(f"_mean_{c}") - m) * F.sqrt("_rows") for c, m in zip(columns, centre, strict=True)])
    inside = every - between
    if (np.diag(inside) >= INSIDE * np.diag(every)).all() and np.linalg.eigvalsh(_scaled(inside)[1])[0] >= TIED:
        return inside
    joined = train.join(means, train[key].eqNullSafe(means["_mean_key"]))
    return products(joined, [F.col(c).cast("double") - F.col(f"_mean_{c}") for c in columns])


def key_means(train: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """A row per key: its number of rows, those that can't be fitted, and the means."""
    value = [F.col(c).cast("double") for c in columns]
    finite = F.lit(True)
    for v in value:
        finite = finite & v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    return train.groupBy(F.col(key).alias("_mean_key")).agg(
        F.count("*").alias("_rows"), F.count_if(~finite).alias("_unfit"),
        *((F.sum(v) / F.count("*")).alias(f"_mean_{c}") for c, v in zip(columns, value, strict=True)),
    )


def fit_absorbed(
    train: DataFrame, features: Sequence[str], label: str, key: str = "city", name: str = "linear"
) -> AbsorbedLinear:
    columns = [*features, label]
    means = saved(key_means(train, columns, key), "key-means")
    weights = solved(centred_products(train, means, columns, key))

    effect = F.col(f"_mean_{label}")
    for feature, weight in zip(features, weights, strict=True):
        effect = effect - F.col(f"_mean_{feature}") * F.lit(weight)
    effects = means.select(F.col("_mean_key").alias(key), effect.alias("_effect"))
    unseen = effects.agg(F.avg("_effect")).first()[0]
    return AbsorbedLinear(name, tuple(features), key, tuple(weights), effects, unseen)
