"""Versioned keyed tables on Parquet: get-or-create, read, upsert.

Layout: ``<root>/_tables`` holds one catalog row per table and version;
``<root>/<name>/v<version>/month_part=YYYY-MM/`` holds the rows, and
``<root>/<name>/v<version>.schema`` their columns, declared by the first batch and used
by every read. A table whose unit is the day has a folder per day instead: what a batch rewrites is
whole units. A table has one writer at a time.

A batch is visible as a whole or not at all, however many folders it touches: its folders are written beside the table, in
``v<version>.pending``, and the file that Spark writes last makes them valid. From then on readers take them in place of the
table's own. They are then moved to their places, one by one; what a failed writer left is moved by the next one, and folders that were
never made valid are dropped. Folders a batch does not touch are left alone.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.session import saved

#: How a unit names its folders: the column, and the same format for Spark and for Python.
UNITS = {"month": ("month_part", "yyyy-MM", "%Y-%m"), "day": ("day_part", "yyyy-MM-dd", "%Y-%m-%d")}

#: Ends the name of a pending batch that is the whole table.
REPLACING = "-whole"

CATALOG = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("version", T.IntegerType(), False),
        T.StructField("description", T.StringType()),
        T.StructField("primary_key", T.ArrayType(T.StringType()), False),
        T.StructField("event_time", T.StringType(), False),
        T.StructField("unit", T.StringType()),  # NULL in catalogs older than units: month
    ]
)


def _path(spark: SparkSession, path: str):
    """The file system and its own path object; asks for one name, lists nothing."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def path_exists(spark: SparkSession, path: str) -> bool:
    files, where = _path(spark, path)
    return files.exists(where)


def create_file(spark: SparkSession, path: str) -> bool:
    """Make an empty file; False if it is there already. Of several callers, one gets True."""
    files, where = _path(spark, path)
    files.mkdirs(where.getParent())
    try:
        return files.createNewFile(where)
    except Py4JJavaError as error:  # another caller was first
        if "FileAlreadyExists" in str(error.java_exception):
            return False
        raise


def folder_names(spark: SparkSession, path: str) -> list[str]:
    files, where = _path(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(where) if f.isDirectory())


def _known(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The same rows; one with NULL in a key column raises, as no upsert could find it again."""
    kinds = {f.name: f.dataType for f in df.schema.fields}

    def known(c: str) -> Column:
        missing = F.raise_error(F.lit(f"NULL in key column {c}")).cast(kinds[c])
        return F.when(F.col(c).isNull(), missing).otherwise(F.col(c))

    return df.withColumns({c: known(c) for c in key})


def latest_per_pk(df: DataFrame, pk: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """One row per primary key: the one with the highest ``newest`` columns.

    The rank filter lets Spark keep one row per key in each task before the
    shuffle, so a key with very many copies costs no more than any other.
    """
    order = [F.col(c).desc() for c in newest] or [F.lit(1)]
    rank = F.row_number().over(Window.partitionBy(*pk).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def merge_rows(existing: DataFrame, batch: DataFrame, pk: Sequence[str]) -> DataFrame:
    """``existing`` with the rows of ``batch`` replaced or added."""
    kept = existing.join(batch.select(*pk), list(pk), "left_anti")
    return kept.unionByName(batch)


@dataclass(frozen=True)
class KeyedTable:
    spark: SparkSession
    path: str
    primary_key: tuple[str, ...]
    event_time: str
    description: str | None = None
    unit: str = "month"

    @property
    def _part(self) -> str:
        return UNITS[self.unit][0]

    def part_of(self, day: dt.date) -> str:
        """The folder name of a day's rows."""
        return day.strftime(UNITS[self.unit][2])

    def part(self) -> Column:
        """The folder name of a row; a row without event time has none and raises."""
        missing = F.raise_error(F.lit(f"NULL in event time {self.event_time}")).cast("string")
        return F.coalesce(F.date_format(self.event_time, UNITS[self.unit][1]), missing)

    def exists(self) -> bool:
        return path_exists(self.spark, self.path) or bool(self._pending()[0])

    @property
    def _pending_path(self) -> str:
        return f"{self.path}.pending"

    def _batches(self) -> list[tuple[str, bool]]:
        """The folders of batches that aren't in place, oldest first, and whether they are valid."""
        if not path_exists(self.spark, self._pending_path):
            return []
        at = [f"{self._pending_path}/{n}" for n in folder_names(self.spark, self._pending_path)]
        return [(a, path_exists(self.spark, f"{a}/_SUCCESS")) for a in at]

    def _folders(self, path: str) -> dict[str, str]:
        """The unit folders below ``path``, by month or day."""
        prefix = f"{self._part}="
        return {n.removeprefix(prefix): f"{path}/{n}" for n in folder_names(self.spark, path) if n.startswith(prefix)}

    def _pending(self) -> tuple[dict[str, str], bool]:
        """Valid folders that aren't in place yet, and whether they are all there is (a replaced table)."""
        found, alone = {}, False
        for at, valid in self._batches():
            if valid:
                whole = at.endswith(REPLACING)
                found, alone = {} if whole else found, alone or whole
                found |= self._folders(at)
        return found, alone

    def _settle(self) -> None:
        """Move the folders of valid batches to their places and drop the others."""
        for at, valid in self._batches():
            files, where = _path(self.spark, at)
            if valid:
                files.mkdirs(_path(self.spark, self.path)[1])
                if at.endswith(REPLACING):
                    kept = {f.rsplit("/", 1)[1] for f in self._folders(at).values()}
                    for folder in self._folders(self.path).values():
                        if folder.rsplit("/", 1)[1] not in kept:
                            files.delete(_path(self.spark, folder)[1], True)
                for folder in self._folders(at).values():
                    self._put(folder)
            files.delete(where, True)

    def _put(self, folder: str) -> None:
        files, where = _path(self.spark, folder)
        _, target = _path(self.spark, f"{self.path}/{where.getName()}")
        files.mkdirs(target.getParent())
        files.delete(target, True)
        if not files.rename(where, target):
            raise OSError(f"{where} can't be moved to {target}")

    @property
    def _schema_path(self) -> str:
        return f"{self.path}.schema"

    def schema(self) -> T.StructType | None:
        """The declared columns; None before the first batch."""
        if path_exists(self.spark, self._schema_path):
            return T.StructType.fromJson(json.loads(self.spark.read.text(self._schema_path).first()[0]))
        if self.exists():  # written before schemas were kept
            return self.spark.read.parquet(self.path).drop(self._part).schema
        return None

    def _declare(self, schema: T.StructType) -> None:
        row = self.spark.createDataFrame([(schema.json(),)], "value string")
        row.coalesce(1).write.mode("overwrite").text(self._schema_path)

    def add_columns(self, columns: str) -> None:
        """Declare more columns, as in ``"x double"``; earlier rows are NULL there."""
        have = self.schema()
        if have is None:
            raise ValueError("the table has no columns yet")
        self._declare(T.StructType([*have.fields, *T.StructType.fromDDL(columns).fields]))

    def _checked(self, batch: DataFrame) -> DataFrame:
        """``batch`` in the declared order; other columns, types or NULL keys are refused."""
        have = self.schema()
        if have is None:
            have = batch.schema
        kinds, own = ({f.name: f.dataType for f in s.fields} for s in (have, batch.schema))
        if kinds != own:
            odd = sorted(c for c in kinds.keys() | own.keys() if kinds.get(c) != own.get(c))
            raise ValueError(f"columns differ from the table's: {', '.join(odd)}")
        if not path_exists(self.spark, self._schema_path):
            self._declare(have)
        keys = [c for c in self.primary_key if c != self.event_time]  # part() looks at that one
        return _known(batch.select(*have.names), keys)

    def parts(self) -> list[str]:
        """The months, or days, present: from one look at the table's folder."""
        pending, alone = self._pending()
        placed = {} if alone or not path_exists(self.spark, self.path) else self._folders(self.path)
        return sorted(placed | pending)

    def _reader(self) -> DataFrameReader:
        schema = self.schema()
        return self.spark.read if schema is None else self.spark.read.schema(schema)

    def read(
        self,
        since: dt.date | None = None,
        until: dt.date | None = None,
        parts: Sequence[str] | None = None,
    ) -> DataFrame:
        """The rows, ``since`` and ``until`` included.

        With any bound only the folders of those months, or days, are listed and read.
        """
        pending, _ = self._pending()
        if since is None and until is None and parts is None and not pending:
            return self._reader().parquet(self.path).drop(self._part)
        asked = None if parts is None else set(parts)
        wanted = [
            p
            for p in self.parts()
            if (asked is None or p in asked)
            and (since is None or p >= self.part_of(since))
            and (until is None or p <= self.part_of(until))
        ]
        if not wanted:
            return self.spark.createDataFrame([], self.schema())
        folders = [pending.get(p, f"{self.path}/{self._part}={p}") for p in wanted]
        reader = self._reader()
        # folders in one place have it as their base; others stand for themselves
        reader = reader if pending else reader.option("basePath", self.path)
        df = reader.parquet(*folders).drop(self._part)
        day = F.to_date(self.event_time)
        if since is not None:
            df = df.where(day >= F.lit(since))
        if until is not None:
            df = df.where(day <= F.lit(until))
        return df

    def last_day(self, until: dt.date | None = None) -> dt.date | None:
        """The last event day, up to ``until``: folders are read newest first, and
        the first one with a row ends the search."""
        for part in reversed(self.parts()):
            if until is None or part <= self.part_of(until):
                rows = self.read(until=until, parts=[part])
                day = rows.agg(F.max(F.to_date(self.event_time))).first()[0]
                if day is not None:
                    return day
        return None

    def trailing(self, days: int = 15, until: dt.date | None = None) -> DataFrame:
        """Rows at most ``days`` before the last day, reading only their months."""
        last = self.last_day(until)
        if last is None:
            return self.read().where(F.lit(False))
        return self.read(last - dt.timedelta(days=days), last)

    @property
    def keys(self) -> tuple[str, ...]:
        """The primary key without the event time: what has one row per time."""
        return tuple(c for c in self.primary_key if c != self.event_time)

    @property
    def _latest_path(self) -> str:
        return f"{self.path}.latest"

    def track_latest(self) -> None:
        """Keep every key's last day from now on, in a table of one row per key that each upsert brings up to date.

        Call it again should an upsert have failed after its rows were written."""
        days = self.read() if self.exists() else self.spark.createDataFrame([], self.schema())
        self._write_latest(self._last_of(days))

    def _last_of(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(F.max(F.to_date(self.event_time)).alias("last_day"))

    def _latest_versions(self) -> list[int]:
        if not path_exists(self.spark, self._latest_path):
            return []
        names = folder_names(self.spark, self._latest_path)
        done = [n for n in names if path_exists(self.spark, f"{self._latest_path}/{n}/_SUCCESS")]
        return sorted(int(n.removeprefix("v")) for n in done)

    def _write_latest(self, last: DataFrame) -> None:
        """A new version beside the one in use, which readers keep until the new one is complete."""
        version = max(self._latest_versions(), default=0) + 1
        last.write.mode("overwrite").parquet(f"{self._latest_path}/v{version}")

    def last_days(self) -> DataFrame:
        """``(keys, last_day)``: every key's last day, from the tracked table."""
        versions = self._latest_versions()
        if not versions:
            raise ValueError("the table's last days aren't tracked: call track_latest first")
        return self.spark.read.parquet(f"{self._latest_path}/v{versions[-1]}")

    def _touched(self, days: int) -> list[str]:
        """The folders that hold some key's last ``days`` days: a short string each."""
        name = UNITS[self.unit][1]
        spans = F.explode(F.sequence(F.date_sub("last_day", days), F.col("last_day"), F.expr("INTERVAL 1 DAY"))).alias("d")
        found = self.last_days().select("last_day").distinct().select(spans).select(F.date_format("d", name)).distinct()
        return [r[0] for r in found.collect()]

    def trailing_per_key(self, days: int = 15) -> DataFrame:
        """Rows at most ``days`` before their key's last day, however long ago that is; only folders that hold such days are read."""
        rows = self.read(parts=self._touched(days))
        last = self.last_days().withColumnsRenamed({k: f"_{k}" for k in self.keys})
        same = [F.col(k) == F.col(f"_{k}") for k in self.keys]
        near = F.to_date(self.event_time) >= F.date_sub("last_day", days)
        return rows.join(last, [*same, near]).select(*(rows[c] for c in rows.columns))

    def latest(self) -> DataFrame:
        """Every key's rows of its last day."""
        return self.trailing_per_key(0)

    def upsert(self, batch: DataFrame, newest: Sequence[str] = ()) -> None:
        """Replace rows with equal primary key, add the rest, delete nothing.

        Only the folders of the batch are read and rewritten. A batch must have the
        table's columns, and a value in each key column. Where one batch
        holds a key twice, the row with the highest ``newest`` columns wins.
        """
        self._upsert(batch, newest, changes=False)

    def upsert_changes(self, batch: DataFrame, newest: Sequence[str] = ()) -> DataFrame:
        """Upsert, and the primary keys of the rows that this really changed: new ones, and those with another value."""
        return self._upsert(batch, newest, changes=True)

    def _upsert(self, batch: DataFrame, newest: Sequence[str], changes: bool) -> DataFrame | None:
        self._settle()  # what a failed writer left
        batch = self._checked(latest_per_pk(batch, self.primary_key, newest).drop(*newest))
        # The batch is used three times below; executors keep it, spilling to disk.
        batch = batch.persist()
        try:
            changed = None
            if not self.exists():
                self._write(batch)
                changed = saved(batch.select(*self.primary_key), "changes") if changes else None
            else:
                # One short string per folder touched: the driver holds no rows.
                parts = [r[0] for r in batch.select(self.part()).distinct().collect()]
                if changes:
                    changed = saved(self._changed(batch, parts), "changes")
                if parts:
                    self._write(merge_rows(self.read(parts=parts), batch, self.primary_key))
            if self.keys and self._latest_versions():
                self._write_latest(self.last_days().unionByName(self._last_of(batch)).groupBy(*self.keys).agg(F.max("last_day").alias("last_day")))
            return changed
        finally:
            batch.unpersist()

    def _changed(self, batch: DataFrame, parts: Sequence[str]) -> DataFrame:
        pk, values = list(self.primary_key), [c for c in batch.columns if c not in self.primary_key]
        as_one = F.struct(*(F.col(c) for c in values)) if values else F.lit(True)
        before = self.read(parts=parts).select(*pk, as_one.alias("_before"), F.lit(True).alias("_there"))
        both = batch.select(*pk, as_one.alias("_now")).join(before, pk, "left")
        return both.where(F.col("_there").isNull() | ~F.col("_now").eqNullSafe(F.col("_before"))).select(*pk)

    def replace(self, df: DataFrame) -> None:
        """Make ``df`` the whole table, dropping rows it lacks."""
        self._write(self._checked(latest_per_pk(df, self.primary_key, ())), replace=True)
        if self.keys and self._latest_versions():
            self.track_latest()

    def _write(self, df: DataFrame, replace: bool = False) -> None:
        out = df.withColumn(self._part, self.part())
        at = f"{self._pending_path}/{len(self._batches()):06d}-{uuid.uuid4().hex}{REPLACING if replace else ''}"
        # Rebalancing gathers each folder into few files, and splits one too
        # large for one task.
        out.hint("rebalance", self._part).write.partitionBy(self._part).parquet(at)
        self._settle()


class PanelStore:
    """Keyed tables below one folder every executor can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    @property
    def _catalog_path(self) -> str:
        return f"{self.root}/_tables"

    def tables(self) -> DataFrame:
        """One row per table and version."""
        if not path_exists(self.spark, self._catalog_path):
            return self.spark.createDataFrame([], CATALOG)
        return self.spark.read.schema(CATALOG).parquet(self._catalog_path)

    def _lookup(self, name: str, version: int) -> KeyedTable | None:
        found = self.tables().where((F.col("name") == name) & (F.col("version") == version)).first()
        if found is None:
            return None
        return KeyedTable(
            self.spark,
            f"{self.root}/{name}/v{version}",
            tuple(found.primary_key),
            found.event_time,
            found.description,
            found.unit or "month",
        )

    def get(self, name: str, version: int = 1) -> KeyedTable:
        table = self._lookup(name, version)
        if table is None:
            raise KeyError(f"no table {name} version {version}")
        return table

    def get_or_create(
        self,
        name: str,
        primary_key: Sequence[str],
        event_time: str,
        version: int = 1,
        description: str | None = None,
        unit: str = "month",
    ) -> KeyedTable:
        """``unit`` is the span of a folder, ``month`` or ``day``: choose what one batch rewrites."""
        if unit not in UNITS:
            raise ValueError(f"unit {unit} is not one of {', '.join(UNITS)}")
        table = self._lookup(name, version)
        if table is None:
            row = [(name, version, description, list(primary_key), event_time, unit)]
            self.spark.createDataFrame(row, CATALOG).write.mode("append").parquet(
                self._catalog_path
            )
            table = self.get(name, version)
        if (table.primary_key, table.event_time, table.unit) != (tuple(primary_key), event_time, unit):
            raise ValueError(f"{name} version {version} has another key, event time or unit")
        return table

    def read(
        self, name: str, version: int = 1, fallback: Callable[[], DataFrame] | None = None
    ) -> DataFrame:
        """The table, or ``fallback()`` where it is unknown or cannot be analysed."""
        try:
            return self.get(name, version).read()
        except (KeyError, AnalysisException):
            if fallback is None:
                raise
            return fallback()
