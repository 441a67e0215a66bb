import datetime as dt
import json
import os
import random

import pytest

from panelcast.operators.daily import daily_mean_of_feeds
from panelcast.plans import ingest
from panelcast.session import fresh_folder
from panelcast.sources import files, payloads
from panelcast.sources.dimension import key_dimension, site_names, with_location
from panelcast.sources.store import PanelStore
from panelcast.streaming.daily import start_daily_mean
from panelcast.streaming.refresh import start_refresh

T0 = dt.datetime(2024, 1, 1)


class Landing:
    """Payload files whose modification times follow the order of writing."""

    def __init__(self, root):
        self.root, self.n = str(root), 0
        for feed in ("air", "weather"):
            os.makedirs(f"{root}/{feed}")

    def path(self, feed):
        return f"{self.root}/{feed}"

    def put(self, feed, city, hours, value):
        times = [(T0 + dt.timedelta(hours=h)).strftime("%Y-%m-%dT%H:%M") for h in hours]
        names = {
            "air": payloads.AIR_FIELDS,
            "weather": payloads.WEATHER_FIELDS,
        }[feed]
        values = [value(h) for h in hours]
        document = {"city": city, "hourly": {"time": times, **{n: values for n in names}}}
        self.n += 1
        path = f"{self.root}/{feed}/{self.n:04d}.json"
        with open(path, "w") as out:
            out.write(json.dumps(document) + "\n")
        os.utime(path, (1_700_000_000 + self.n, 1_700_000_000 + self.n))


def rows(df):
    table = df.select("city", "date", "pm2_5", "temperature", "n_obs").collect()
    return sorted((r[0], r[1], round(r[2], 9), round(r[3], 9), r[4]) for r in table)


@pytest.fixture
def landing(tmp_path):
    return Landing(tmp_path)


def land_shuffled(landing, seed):
    jobs = [
        (feed, city, range(start, start + 30))
        for feed in ("air", "weather")
        for city in ("a", "b")
        for start in range(0, 240, 24)
    ]
    random.Random(seed).shuffle(jobs)
    for feed, city, hours in jobs:
        landing.put(feed, city, hours, lambda h: float(h % 13))


def batch_result(spark, landing):
    air = payloads.read_air(spark, landing.path("air")).distinct()
    weather = payloads.read_weather(spark, landing.path("weather")).distinct()
    return rows(daily_mean_of_feeds(air, weather))


def run_refresh(spark, landing, store, checkpoint, **kwargs):
    start_refresh(
        spark, landing.path("air"), landing.path("weather"), store, checkpoint, **kwargs
    ).awaitTermination()


@pytest.mark.parametrize("seed", [1, 2])
def test_stream_equals_batch_in_any_order(spark, landing, seed):
    land_shuffled(landing, seed)
    store = PanelStore(spark, fresh_folder(spark, "store"))
    run_refresh(spark, landing, store, fresh_folder(spark, "cp"), files_per_batch=8)
    found = rows(store.read("daily_measures"))
    assert len(found) == 2 * 11
    assert found == batch_result(spark, landing)


def test_late_and_revised_hours_replace_their_days(spark, landing):
    store, checkpoint = PanelStore(spark, fresh_folder(spark, "store")), fresh_folder(spark, "cp")
    landing.put("air", "a", range(12), lambda h: 1.0)
    landing.put("weather", "a", range(24), lambda h: 2.0)
    run_refresh(spark, landing, store, checkpoint)
    assert [(r[2], r[4]) for r in rows(store.read("daily_measures"))] == [(1.0, 12)]
    landing.put("air", "a", range(6, 24), lambda h: 3.0)
    run_refresh(spark, landing, store, checkpoint)
    assert [(r[2], r[4]) for r in rows(store.read("daily_measures"))] == [(2.5, 24)]


def test_hours_before_the_window_are_left_alone(spark, landing):
    store, checkpoint = PanelStore(spark, fresh_folder(spark, "store")), fresh_folder(spark, "cp")
    landing.put("weather", "a", range(240), lambda h: 2.0)
    landing.put("air", "a", range(240), lambda h: 1.0)
    run_refresh(spark, landing, store, checkpoint)
    landing.put("air", "a", range(240), lambda h: 9.0)
    run_refresh(spark, landing, store, checkpoint, as_of=dt.date(2024, 1, 9))
    found = {r[1].day: r[2] for r in rows(store.read("daily_measures"))}
    assert found == {d: 9.0 if 6 <= d <= 9 else 1.0 for d in range(1, 11)}


def test_replayed_batch_changes_nothing(spark, landing):
    land_shuffled(landing, 3)
    store = PanelStore(spark, fresh_folder(spark, "store"))
    run_refresh(spark, landing, store, fresh_folder(spark, "cp"))
    once = rows(store.read("daily_measures"))
    run_refresh(spark, landing, store, fresh_folder(spark, "cp"))
    assert rows(store.read("daily_measures")) == once


def test_watermark_drops_hours_older_than_the_bound(spark, landing):
    table = ingest.daily_table(PanelStore(spark, fresh_folder(spark, "store")))
    checkpoint = fresh_folder(spark, "cp")

    def run():
        hours = payloads.read_air(spark, landing.path("air"), stream=True)
        start_daily_mean(hours, ["pm2_5", "pm10"], table, checkpoint).awaitTermination()

    landing.put("air", "a", range(0, 12), lambda h: 1.0)
    landing.put("air", "a", range(24 * 8, 24 * 8 + 6), lambda h: 1.0)
    run()
    landing.put("air", "a", range(12, 24), lambda h: 5.0)
    landing.put("air", "a", range(24 * 6, 24 * 6 + 3), lambda h: 7.0)
    run()
    found = {r.date.day: (r.pm2_5, r.n_obs) for r in table.read().collect()}
    assert found == {1: (1.0, 12), 7: (7.0, 3), 9: (1.0, 6)}


def test_days_do_not_depend_on_the_session_zone(spark, landing):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Karachi")
    try:
        landing.put("air", "a", range(48), lambda h: 1.0)
        table = ingest.daily_table(PanelStore(spark, fresh_folder(spark, "store")))
        hours = payloads.read_air(spark, landing.path("air"), stream=True)
        start_daily_mean(hours, ["pm2_5"], table, fresh_folder(spark, "cp")).awaitTermination()
        assert {r.date.day: r.n_obs for r in table.read().collect()} == {1: 24, 2: 24}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


# --- files and payloads -----------------------------------------------------------


def test_payload_fields_are_renamed_and_nulls_survive(spark, landing):
    landing.put("weather", "a", [0, 1], lambda h: None if h else 4.0)
    found = payloads.read_weather(spark, landing.path("weather")).orderBy("time").collect()
    assert found[0].asDict() == {
        "city": "a", "time": T0, "temperature": 4.0, "humidity": 4.0, "wind_speed": 4.0, "pressure": 4.0,
    }
    assert found[1].pressure is None


def test_current_payload(spark, tmp_path):
    path = tmp_path / "now.json"
    path.write_text('{"current": {"time": "2024-01-01T07:00", "pm10": 3.5, "pm2_5": 2.5}}\n')
    row = payloads.read_current(spark, str(path)).first()
    assert row.asDict() == {"time": T0 + dt.timedelta(hours=7), "pm10": 3.5, "pm2_5": 2.5}


def test_air_csv_with_dotted_header(spark, tmp_path):
    path = tmp_path / "air.csv"
    path.write_text("time,PM10,PM2.5\n2024-01-01T00:00,1.5,NaN\n2024-01-01T01:00,,2.5\n")
    found = files.read_air_csv(spark, str(path)).orderBy("time").collect()
    assert [tuple(r) for r in found] == [
        (T0, 1.5, None), (T0 + dt.timedelta(hours=1), None, 2.5),
    ]


def test_wrong_csv_header_raises(spark, tmp_path):
    path = tmp_path / "air.csv"
    path.write_text("time,PM2.5,PM10\n2024-01-01T00:00,1.5,2.5\n")
    with pytest.raises(Exception, match="header|HEADER"):
        files.read_air_csv(spark, str(path)).collect()


def test_key_dimension(spark):
    sites = key_dimension(spark)
    assert site_names(sites).count() == 5
    df = spark.createDataFrame([("Karachi",), ("Nowhere",)], "city string")
    assert {r.city: r.lat for r in with_location(df, sites).collect()} == {
        "Karachi": 24.8607, "Nowhere": None,
    }


def test_a_feed_delivered_twice_counts_once(spark, landing):
    """Copies in the same run and in a later one; the first arrival of an hour counts."""
    table = ingest.daily_table(PanelStore(spark, fresh_folder(spark, "store")))
    checkpoint = fresh_folder(spark, "cp")
    for more in (0.0, 50.0):
        for _ in range(2):
            landing.put("air", "a", range(48), lambda h, more=more: h + more)
        hours = payloads.read_air(spark, landing.path("air"), stream=True)
        start_daily_mean(hours, ["pm2_5", "pm10"], table, checkpoint).awaitTermination()
    assert {r.date.day: (r.pm2_5, r.n_obs) for r in table.read().collect()} == {1: (11.5, 24), 2: (35.5, 24)}
