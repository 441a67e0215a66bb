"""Sessions for tests and benches, and the shared folder jobs may write to."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, name: str = "panelcast", memory: str = "12g") -> SparkSession:
    """A ``local[n]`` session. On a cluster, use the session the cluster gives."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset, the session's checkpoint folder is used; a scratch folder
    is made only for a local master, as the executors of a cluster would not see
    a machine-local path.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="panelcast-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new path of its own below the shared folder."""
    return os.path.join(shared_folder(spark), f"{label}-{uuid.uuid4().hex}")


def saved(df: DataFrame, label: str) -> DataFrame:
    """The same rows, written to the shared folder and read back: whoever reads them
    several times computes them once, and a lost executor costs no recomputation."""
    path = fresh_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
