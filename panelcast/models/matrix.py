"""From a feature table to the vectors Spark ML fits on.

The key is encoded inside the fitted pipeline, with the levels seen in training,
so a loaded model needs nothing but the raw columns.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Transformer
from pyspark.ml.base import Estimator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.functions.derived import feature_names

FEATURES = "features"

# Derived features that are exact linear combinations of inputs: name -> weights.
LINEAR_RELATIONS = {
    "aqi_change_rate": {"pm25_lag_1": 1.0 / 3.0, "pm25_lag_3": -1.0 / 3.0},
    "pm25_trend": {"pm25_lag_1": 1.0, "pm25_lag_7": -1.0},
}


def linear_feature_names(horizon: int) -> list[str]:
    """The features without those that add no rank to a linear model.

    Leaving them out changes no prediction and keeps the normal equations
    regular.
    """
    return [f for f in feature_names(horizon) if f not in LINEAR_RELATIONS]


def matrix_stages(features: Sequence[str], key: str | None = "city") -> list[Estimator | Transformer]:
    """Pipeline stages that end in the ``features`` vector.

    The key becomes one sparse vector with a place for each key seen in training, so the plan is
    the same for any number of keys. Rows with another key, or none, are 0 everywhere in it.
    """
    if key is None:
        return [VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid="error")]
    return [
        StringIndexer(inputCol=key, outputCol="_key_index", handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=["_key_index"], outputCols=["_key_vector"], dropLast=True),
        VectorAssembler(inputCols=[*features, "_key_vector"], outputCol=FEATURES, handleInvalid="error"),
    ]


# Rows of a training task: few at first, so that small tables use many cores, more
# once there are PARTS tasks.
ROWS_PER_PART = 2_000
PARTS = 4_096
MOST_ROWS_PER_PART = 1_000_000


def spread(train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The training columns dealt by content, in an order given by content.

    How many parts there are depends on the number of rows alone, so a seeded
    forest is the same on any number of cores and however the rows were stored.
    """
    rows = train.select(*columns)
    n = rows.count()
    parts = min(math.ceil(n / ROWS_PER_PART), max(PARTS, math.ceil(n / MOST_ROWS_PER_PART)))
    return rows.repartition(max(1, parts), F.xxhash64(*columns)).sortWithinPartitions(*columns)
