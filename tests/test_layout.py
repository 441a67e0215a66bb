"""Clustered tables and stored summaries."""

import datetime as dt
import re
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.operators.summaries import DISTINCT_ERROR, RANK_ERROR, SummaryTable
from panelcast.plans.features import daily_features
from panelcast.session import fresh_folder, saved
from panelcast.sources.clustered import ClusteredTable
from panelcast.sources.store import PanelStore
from panelcast.spec import DAILY


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    days = [(f"k{k}", dt.date(2023, 11, 1) + dt.timedelta(days=d)) for k in range(12) for d in range(430) if (k + d) % 11]
    data = [(*kd, float(v), None if i % 17 == 0 else float(round(v, 1))) for i, (kd, v) in enumerate(zip(days, rng.lognormal(3, 1, len(days)), strict=True))]
    return saved(spark.createDataFrame(data, "city string, date date, pm2_5 double, pm10 double"), "rows")


@pytest.fixture
def table(spark, rows):
    made = ClusteredTable(spark, f"t{uuid.uuid4().hex}", ("city",), "date", 4)
    made.create(rows.where("date < '2024-06-01'"))
    yield made
    spark.sql(f"DROP TABLE {made.name}")


def test_windows_and_joins_by_key_need_no_exchange(spark, table, rows):
    ranked = table.read().withColumn("before", F.lag("pm2_5").over(DAILY.window()))
    assert "Exchange" not in plan(ranked) and "Window" in plan(ranked)
    assert "Exchange" not in plan(daily_features(table.read()))
    assert "Exchange" in plan(daily_features(rows))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        both = table.read().groupBy("city").agg(F.avg("pm2_5").alias("m")).join(table.read(), "city")
        assert "Exchange" not in plan(both) and "SortMergeJoin" in plan(both)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_upsert_keeps_the_buckets(spark, table, rows):
    files = lambda: {f for f in table.read().inputFiles()}
    before = files()
    table.upsert(rows.where("date >= '2024-05-15'").withColumn("pm2_5", F.col("pm2_5") + 1))
    untouched = {f for f in before if re.search("month_part=(2023|2024-0[1-4])", f)}
    assert untouched and untouched <= files()
    wanted = rows.withColumn("pm2_5", F.when(F.col("date") >= "2024-05-15", F.col("pm2_5") + 1).otherwise(F.col("pm2_5")))
    assert table.read().exceptAll(wanted).count() == 0 and table.read().count() == wanted.count()
    features = daily_features(table.read())
    assert "Exchange" not in plan(features)
    assert features.select("city", "date", "pm25_rolling_7").exceptAll(daily_features(wanted).select("city", "date", "pm25_rolling_7")).count() == 0
    # a file per bucket and month at most
    per = {}
    for f in files():
        per.setdefault((re.search("month_part=([0-9-]+)", f).group(1), re.search(r"_(\d{5})", f).group(1)), []).append(f)
    assert max(map(len, per.values())) == 1
    table.upsert(rows.limit(0))


def test_a_years_profile_reads_summaries_only(spark, rows):
    store = PanelStore(spark, fresh_folder(spark, "store"))
    kept = SummaryTable.in_store(store, "summaries", ["pm2_5", "pm10"])
    kept.update(rows.where("date < '2024-08-01'"))
    kept.update(rows.where("date >= '2024-08-01'"))
    found = kept.profile(dt.date(2024, 1, 1), dt.date(2024, 12, 31))
    assert all("summaries" in f for f in found.inputFiles())
    exact = rows.where("date >= '2024-01-01' and date < '2025-01-01'").toPandas()
    for r in found.collect():
        values = exact[r.column].dropna().to_numpy()
        assert (r.n, r.nulls) == (len(values), exact[r.column].isna().sum())
        assert (r.min, r.max) == (values.min(), values.max())
        assert (r["mean"], r["std"]) == pytest.approx((values.mean(), values.std(ddof=1)))
        for name, q in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
            # a rank's error, ties counted in its favour
            low, high = (values < r[name]).mean(), (values <= r[name]).mean()
            assert low - RANK_ERROR <= q <= high + RANK_ERROR
        assert abs(r.kinds - len(set(values))) <= 3 * DISTINCT_ERROR * len(set(values)) + 1
    each = kept.profile(per_key=True)
    assert each.count() == 24 and each.agg(F.sum("n")).first()[0] == rows.agg(F.count("pm2_5") + F.count("pm10")).first()[0]
