import datetime as dt
import hashlib
import random
from pathlib import Path

import pytest
from frames import day, panel
from pyspark.sql import functions as F

from panelcast.plans import ingest
from panelcast.plans.features import daily_features, serving_rows
from panelcast.session import fresh_folder
from panelcast.sources.store import KeyedTable, PanelStore
from panelcast.spec import DAILY, MEASURES


@pytest.fixture
def store(spark):
    return PanelStore(spark, fresh_folder(spark, "store"))


def keyed(store, **kwargs):
    return store.get_or_create("t", ["city", "date"], "date", **kwargs)


def rows(df):
    return sorted(tuple(r) for r in df.select("city", "date", "pm2_5").collect())


def files(table):
    return {
        str(p.relative_to(table.path)): hashlib.md5(p.read_bytes()).hexdigest()
        for p in Path(table.path).rglob("*.parquet")
    }


def test_upsert_is_idempotent_and_keeps_keys_unique(spark, store):
    table = keyed(store)
    first = panel(spark, [(c, i, 1.0) for c in "ab" for i in range(40)])
    second = panel(spark, [("a", i, 2.0) for i in range(35, 45)])
    table.upsert(first)
    table.upsert(second)
    once = rows(table.read())
    table.upsert(second)
    assert rows(table.read()) == once
    assert len(once) == 85 and len({r[:2] for r in once}) == 85
    assert sum(r[2] == 2.0 for r in once) == 10


def test_untouched_months_keep_their_files(spark, store):
    table = keyed(store)
    table.upsert(panel(spark, [("a", i, 1.0) for i in range(90)]))
    before = files(table)
    table.upsert(panel(spark, [("a", 40, 5.0)]))
    after = files(table)
    same = {f for f in before if "2024-02" not in f}
    assert same and all(after[f] == before[f] for f in same)
    assert {f for f in after if "2024-02" in f}.isdisjoint({f for f in before if "2024-02" in f})


def test_order_of_disjoint_batches_does_not_matter(spark):
    batches = [panel(spark, [("a", i, float(i)) for i in range(s, s + 20)]) for s in (0, 20, 40)]
    results = []
    for order in ([0, 1, 2], [2, 0, 1]):
        table = keyed(PanelStore(spark, fresh_folder(spark, "store")))
        for i in order:
            table.upsert(batches[i])
        results.append(rows(table.read()))
    assert results[0] == results[1]


def test_newest_copy_within_a_batch_wins(spark, store):
    table = keyed(store)
    batch = panel(spark, [("a", 0, float(v)) for v in (3, 9, 5)]).withColumn("seen", F.col("pm2_5"))
    table.upsert(batch, newest=["seen"])
    assert rows(table.read()) == [("a", day(0), 9.0)]
    assert "seen" not in table.read().columns


def test_read_bounds_prune_months(spark, store):
    table = keyed(store)
    table.upsert(panel(spark, [("a", i, 1.0) for i in range(120)]))
    part = table.read(since=dt.date(2024, 2, 10), until=dt.date(2024, 3, 5))
    assert part.count() == 25
    assert {f.split("month_part=")[1][:7] for f in part.inputFiles()} == {"2024-02", "2024-03"}
    assert table.read(since=dt.date(2030, 1, 1)).count() == 0
    assert table.parts() == ["2024-01", "2024-02", "2024-03", "2024-04"]


def test_missing_event_time_is_refused(spark, store):
    with pytest.raises(Exception, match="NULL in event time"):
        keyed(store).upsert(spark.createDataFrame([("a", None, 1.0)], "city string, date date, pm2_5 double"))


def test_replace_drops_vanished_rows(spark, store):
    table = keyed(store)
    table.upsert(panel(spark, [("a", i, 1.0) for i in range(40)]))
    table.replace(panel(spark, [("a", 1, 2.0)]))
    assert rows(table.read()) == [("a", day(1), 2.0)]


def test_catalog_and_fallback(spark, store):
    table = keyed(store, description="first")
    assert keyed(store).path == table.path and store.tables().count() == 1
    assert keyed(store, version=2).path != table.path
    assert store.get("t").description == "first"
    with pytest.raises(ValueError, match="another key"):
        store.get_or_create("t", ["city"], "date")
    with pytest.raises(KeyError):
        store.read("nowhere")
    spare = panel(spark, [("a", 0, 1.0)])
    assert store.read("nowhere", fallback=lambda: spare).count() == 1
    assert store.read("t", fallback=lambda: spare).count() == 1


def test_trailing_reads_only_its_months(spark, store):
    table = keyed(store)
    table.upsert(panel(spark, [("a", i, 1.0) for i in range(120)]))
    assert table.last_day() == day(119) and table.last_day(dt.date(2024, 2, 10)) == dt.date(2024, 2, 10)
    part = table.trailing(15, dt.date(2024, 3, 5))
    assert part.count() == 16
    assert {f.split("month_part=")[1][:7] for f in part.inputFiles()} == {"2024-02", "2024-03"}
    assert table.last_day(dt.date(2020, 1, 1)) is None and table.trailing(1, dt.date(2020, 1, 1)).count() == 0


def test_null_key_is_refused(spark, store):
    table = keyed(store)
    with pytest.raises(Exception, match="NULL in key column city"):
        table.upsert(panel(spark, [("a", 1, 1.0), (None, 1, 2.0)]))


def test_empty_first_batch_is_harmless(spark, store):
    table = keyed(store)
    none = panel(spark, [("a", 1, 1.0)]).where(F.lit(False))
    table.upsert(none)
    assert rows(table.read()) == [] and rows(table.trailing()) == []
    table.upsert(panel(spark, [("a", 1, 1.0)]))
    table.upsert(none)
    assert rows(table.read()) == [("a", day(1), 1.0)]


def test_other_columns_are_refused(spark, store):
    table = keyed(store)
    table.upsert(panel(spark, [("a", 1, 1.0)]).withColumn("pm10", F.lit(2.0)))
    for batch in (
        panel(spark, [("a", 1, 5.0)]),
        panel(spark, [("a", 1, 5.0)]).withColumn("pm10", F.lit("2")),
        panel(spark, [("a", 1, 5.0)]).withColumns({"pm10": F.lit(2.0), "x": F.lit(1)}),
    ):
        with pytest.raises(ValueError, match="columns differ"):
            table.upsert(batch)
    assert table.read().first().pm10 == 2.0


def test_reads_show_the_declared_columns(spark, store):
    table = keyed(store)
    table.upsert(panel(spark, [("a", 1, 1.0)]))
    table.add_columns("pm10 double")
    table.upsert(panel(spark, [("a", 40, 2.0)]).withColumn("pm10", F.lit(3.0)))
    for found in (table.read(), table.read(since=day(0)), table.read(parts=["2024-01"])):
        assert found.columns == ["city", "date", "pm2_5", "pm10"]
    assert {(r.pm2_5, r.pm10) for r in table.read().collect()} == {(1.0, None), (2.0, 3.0)}


def test_day_folders(spark, store):
    table = store.get_or_create("d", ["city", "date"], "date", unit="day")
    table.upsert(panel(spark, [(c, i, 1.0) for c in "ab" for i in range(6)]))
    before = files(table)
    table.upsert(panel(spark, [("a", 3, 5.0), ("a", 60, 6.0)]))
    after = files(table)
    assert {f for f in before if before[f] != after.get(f)} == {f for f in before if "2024-01-04" in f}
    assert table.last_day() == day(60) and table.parts()[-1] == "2024-03-01"
    part = table.read(since=day(2), until=day(3))
    assert rows(part) == [("a", day(2), 1.0), ("a", day(3), 5.0), ("b", day(2), 1.0), ("b", day(3), 1.0)]
    assert len({f.split("day_part=")[1][:10] for f in part.inputFiles()}) == 2
    assert store.get("d").unit == "day"
    with pytest.raises(ValueError, match="unit"):
        store.get_or_create("d", ["city", "date"], "date")


@pytest.mark.parametrize("start", [700, 731, 799])
def test_changed_features_equal_a_full_recomputation(spark, store, start):
    """Keys of every density, one that is new, one that has ended; far folders keep their files."""
    pick = random.Random(start)
    density = {"full": 1.0, "half": 0.5, "rare": 0.05, "ended": 0.5}
    days = [
        (c, i, float(pick.randint(0, 99)))
        for c, share in density.items()
        for i in range(800)
        if pick.random() < share and (c != "ended" or i < 600)
    ] + [("new", i, 1.0) for i in range(795, 800)]
    every = panel(spark, days).withColumns({m: F.col("pm2_5") + 1 for m in DAILY.values if m != "pm2_5"})
    daily = ingest.daily_table(store)
    since = F.lit(day(start))
    daily.upsert(every.where(F.col("date") < since))
    before = files(ingest.refresh_features(store))
    changed = every.where(F.col("date") >= since).withColumn("pm2_5", F.col("pm2_5") * 2)
    daily.upsert(changed)
    table = ingest.refresh_features(store, since=day(start))
    whole = serving_rows(daily_features(daily.read()))
    assert table.read().exceptAll(whole.select(table.read().columns)).isEmpty()
    assert table.read().count() == whole.count()
    after = files(table)
    first = {f for f in before if "2024-0" in f}
    assert first and all(after[f] == before[f] for f in first)


# --- last days and changes ---------------------------------------------------------


def _many_months(spark):
    days = [(k, dt.date(2020, 1, 1) + dt.timedelta(days=d), float(d)) for k, end in (("a", 900), ("b", 100), ("c", 500)) for d in range(end)]
    return spark.createDataFrame(days, "city string, date date, pm2_5 double")


def test_trailing_per_key_touches_only_the_last_folders(spark):
    table = PanelStore(spark, fresh_folder(spark, "store")).get_or_create("t", ("city", "date"), "date")
    rows = _many_months(spark)
    table.upsert(rows.where("date < '2020-06-01'"))
    with pytest.raises(ValueError, match="track_latest"):
        table.last_days()
    table.track_latest()
    table.upsert(rows.where("date >= '2020-06-01'"))
    found = table.trailing_per_key(15)
    assert {(r.city, r.n, r.last) for r in found.groupBy("city").agg(F.count("*").alias("n"), F.max("date").alias("last")).collect()} == {
        ("a", 16, dt.date(2022, 6, 18)), ("b", 16, dt.date(2020, 4, 9)), ("c", 16, dt.date(2021, 5, 14)),
    }
    read = {f.split("month_part=")[1][:7] for f in found.inputFiles() if "month_part=" in f}
    assert read == {"2022-06", "2020-03", "2020-04", "2021-04", "2021-05"}
    assert {(r.city, r.date) for r in table.latest().collect()} == {("a", dt.date(2022, 6, 18)), ("b", dt.date(2020, 4, 9)), ("c", dt.date(2021, 5, 14))}
    table.replace(rows.where("city = 'b'"))
    assert [r.city for r in table.last_days().collect()] == ["b"]


def test_upsert_tells_what_it_changed(spark):
    table = PanelStore(spark, fresh_folder(spark, "store")).get_or_create("t", ("city", "date"), "date")
    rows = _many_months(spark).where("date < '2020-03-01'")
    assert table.upsert_changes(rows).count() == rows.count()
    batch = rows.where("date >= '2020-02-01'").withColumn("pm2_5", F.when((F.col("city") == "a") & (F.col("date") == "2020-02-03"), None).otherwise(F.col("pm2_5")))
    new = spark.createDataFrame([("d", dt.date(2020, 2, 2), 1.0)], "city string, date date, pm2_5 double")
    changed = table.upsert_changes(batch.unionByName(new))
    assert {(r.city, r.date.day) for r in changed.collect()} == {("a", 3), ("d", 2)}
    assert table.upsert_changes(batch).count() == 0


def test_one_changed_key_rewrites_its_rows_only(store, spark, monkeypatch):
    rng = random.Random(1)
    data = [(k, day(d), *(rng.random() for _ in MEASURES)) for k in "abc" for d in range(120) if rng.random() < 0.8]
    table = spark.createDataFrame(data, "city string, date date, " + ", ".join(f"{n} double" for n in MEASURES))
    daily = ingest.daily_table(store)
    daily.upsert(table)
    found = ingest.refresh_features(store)
    read = lambda: {(r.city, r.date): tuple(r)[2:] for r in found.read().collect()}
    before = read()
    span = F.col("date").between(day(40), day(42))
    changes = daily.upsert_changes(table.where(span).withColumn("pm2_5", F.when(F.col("city") == "b", F.col("pm2_5") + 1).otherwise(F.col("pm2_5"))))
    assert {r.city for r in changes.collect()} == {"b"}
    written, upsert = [], KeyedTable.upsert

    def spy(self, batch, newest=()):
        written.extend((r.city, r.date) for r in batch.select("city", "date").collect())
        return upsert(self, batch, newest)

    monkeypatch.setattr(KeyedTable, "upsert", spy)
    ingest.refresh_changed(store, changes)
    monkeypatch.undo()
    after = read()
    assert {k for k, _ in written} == {"b"} and len(written) <= 3 + 7 + 3
    assert {k for k in before if before[k] != after[k]} <= set(written)
    ingest.refresh_features(store, replace=True)
    full = read()
    assert full.keys() == after.keys()
    assert all(x == pytest.approx(y) for k in full for x, y in zip(full[k], after[k], strict=True))
    assert ingest.refresh_changed(store, changes.limit(0)).read().count() == len(full)


# --- all or nothing -----------------------------------------------------------------


def _three_months(spark, value):
    return spark.createDataFrame([("a", dt.date(2024, m, 5), value) for m in (1, 2, 3)], "city string, date date, pm2_5 double")


def test_readers_see_a_batch_as_a_whole_after_a_failure(store, spark, monkeypatch):
    table = keyed(store)
    table.upsert(_three_months(spark, 1.0).unionByName(spark.createDataFrame([("b", dt.date(2023, 12, 1), 1.0)], "city string, date date, pm2_5 double")))
    put, moved = KeyedTable._put, []

    def fails(self, folder):
        if moved:
            raise OSError("lost")
        moved.append(folder)
        put(self, folder)

    monkeypatch.setattr(KeyedTable, "_put", fails)
    with pytest.raises(OSError, match="lost"):
        table.upsert(_three_months(spark, 2.0))
    monkeypatch.undo()
    # one folder is in place, two aren't
    again = keyed(PanelStore(spark, store.root))
    new = [("a", dt.date(2024, m, 5), 2.0) for m in (1, 2, 3)]
    assert rows(again.read()) == [*new, ("b", dt.date(2023, 12, 1), 1.0)]
    assert again.parts() == ["2023-12", "2024-01", "2024-02", "2024-03"]
    assert rows(again.read(since=dt.date(2024, 2, 1))) == new[1:] and again.last_day() == dt.date(2024, 3, 5)
    again.upsert(_three_months(spark, 3.0).where("date < '2024-02-01'"))
    assert [r[2] for r in rows(again.read())] == [3.0, 2.0, 2.0, 1.0]
    assert not Path(again.path + ".pending").exists() or not list(Path(again.path + ".pending").iterdir())


def test_a_batch_that_was_not_completed_is_not_there(store, spark):
    table = keyed(store)
    table.upsert(_three_months(spark, 1.0))
    _three_months(spark, 9.0).withColumn("month_part", F.date_format("date", "yyyy-MM")).write.partitionBy("month_part").parquet(f"{table.path}.pending/broken")
    Path(f"{table.path}.pending/broken/_SUCCESS").unlink()
    assert [r[2] for r in rows(table.read())] == [1.0, 1.0, 1.0]
    table.upsert(_three_months(spark, 2.0).limit(1))
    assert sorted(r[2] for r in rows(table.read())) == [1.0, 1.0, 2.0]


def test_replacing_is_all_or_nothing(store, spark, monkeypatch):
    table = keyed(store)
    table.upsert(_three_months(spark, 1.0))
    monkeypatch.setattr(KeyedTable, "_put", lambda self, folder: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        table.replace(_three_months(spark, 5.0).where("date > '2024-02-01'"))
    monkeypatch.undo()
    assert [r[1:] for r in rows(table.read())] == [(dt.date(2024, 2, 5), 5.0), (dt.date(2024, 3, 5), 5.0)]
    # its input may read the table
    table.replace(table.read().where("date > '2024-03-01'"))
    assert table.parts() == ["2024-03"] and rows(table.read()) == [("a", dt.date(2024, 3, 5), 5.0)]
