"""Plans: what Spark is asked to do, beyond the result being right."""

import re

from pyspark.sql import functions as F

from panelcast.operators import windows
from panelcast.operators.daily import daily_mean_of_feeds
from panelcast.plans import features, sample_queries
from panelcast.sources import sample
from panelcast.spec import DAILY


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(df, node):
    return len(re.findall(rf"[-+] (?:\*\(\d+\) )?{node}\b", plan(df)))


def test_all_daily_windows_share_one_sort(spark, small):
    df = features.daily_features(sample.daily_panel(spark, small))
    assert count(df, "Window") == 1


def test_only_needed_columns_are_read(spark, small):
    text = plan(sample.hourly_air(spark, small).select("city", "time", "pm2_5"))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"ts", "event_type", "value"}


def test_feeds_are_reduced_before_they_are_shuffled(spark, small):
    df = daily_mean_of_feeds(
        sample.hourly_air(spark, small), sample.hourly_weather(spark, small)
    )
    assert "CartesianProduct" not in plan(df) and "BroadcastNestedLoop" not in plan(df)
    assert plan(df).count("partial_sum") > 0


def test_latest_rows_limit_each_task_first(spark, small):
    assert "WindowGroupLimit" in plan(windows.latest_rows(sample.daily_panel(spark, small), DAILY))


def test_chunked_windows_read_their_input_once(spark, small):
    """One scan and one exchange more than the plain form: nothing is computed twice."""
    source = sample.daily_panel(spark, small)
    plain, chunked = features.daily_features(source), features.daily_features(source, chunk="quarter")
    assert plan(chunked).count("FileScan") == plan(plain).count("FileScan")
    assert count(chunked, "Exchange") <= count(plain, "Exchange") + 2
    assert count(chunked, "Sort") <= count(plain, "Sort") + 2


def test_date_filters_reach_the_scan(spark, small):
    events = sample.table(spark, small, "events")
    text = plan(events.where(F.col("ts") >= F.lit("2024-01-20").cast("timestamp_ntz")))
    assert "GreaterThanOrEqual(ts" in text


def test_no_query_pairs_rows_without_a_key(spark, small):
    for name in ("trailing_window", "expanding_folds", "chronological_split", "champion"):
        text = plan(sample_queries.QUERIES[name](spark, small))
        assert "CartesianProduct" not in text and "BroadcastNestedLoop" not in text
