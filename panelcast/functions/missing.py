"""One rule for missing numbers: NULL, never NaN.

Spark's aggregates and comparisons treat NaN as a large number, so every source
turns NaN into NULL before anything else looks at the value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def no_nan(column: Column | str) -> Column:
    return F.nanvl(column, F.lit(None).cast("double"))


def nan_to_null(df: DataFrame) -> DataFrame:
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({name: no_nan(F.col(f"`{name}`")) for name in floats})
