import datetime as dt
import random

import numpy as np
import pytest
from frames import START

from panelcast.operators.profile import describe
from panelcast.operators.ranks import order_statistics, quantiles


def column(spark, items, kind="double"):
    return spark.createDataFrame([(v,) for v in items], f"x {kind}").repartition(7)


@pytest.mark.parametrize("small", [3, 40, 50_000])
def test_ranks_of_skewed_values(spark, small):
    """A third of all rows is one value; the rest is spread over many scales."""
    pick = random.Random(3)
    items = [7.0] * 4000 + [pick.choice([1, -1]) * 10 ** pick.uniform(-9, 9) for _ in range(8000)]
    ordered = sorted(items)
    ranks = [0, 1, 37, 3999, 4000, 5999, 6000, 8000, 11998, 11999]
    found = order_statistics(column(spark, items + [None] * 100), {"x": ranks}, small)
    assert found["x"] == [ordered[r] for r in ranks]


def test_ranks_of_few_distinct_values(spark):
    items = [1.0] * 50 + [2.0] * 49 + [3.0]
    df = column(spark, items)
    assert order_statistics(df, {"x": [0, 49, 50, 98, 99, 100]}, 5)["x"] == [1, 1, 2, 2, 3, None]


def test_ranks_of_times(spark):
    days = [START + dt.timedelta(days=i % 97) for i in range(1000)]
    times = [dt.datetime(2024, 1, 1) + dt.timedelta(minutes=7 * i) for i in range(1000)]
    assert order_statistics(column(spark, days, "date"), {"x": [500]}, 10)["x"] == [sorted(days)[500]]
    found = order_statistics(column(spark, times, "timestamp_ntz"), {"x": [123]}, 10)
    assert found["x"] == [times[123]]


def test_quantiles_are_exact(spark):
    pick = random.Random(5)
    items = [pick.gauss(0, 100) for _ in range(5000)]
    shares = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = quantiles(column(spark, items), ["x"], shares, small=50)["x"]
    assert found == pytest.approx(np.quantile(items, shares).tolist(), rel=1e-12)
    assert quantiles(column(spark, [None]), ["x"], [0.5])["x"] == [None]


def test_describe(spark):
    row = describe(column(spark, [float(i) for i in range(1, 11)] + [None])).first()
    assert (row["count"], row.min, row.p25, row.p50, row.p75, row.max) == (10, 1, 3.25, 5.5, 7.75, 10)
    assert row.std == pytest.approx(np.std(range(1, 11), ddof=1))
