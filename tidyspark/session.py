"""Session helpers: a tuned builder, the shared scratch folder, lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app: str = "tidyspark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators were tuned under.

    Shuffle partitions are left to adaptive execution: start high, coalesce to
    the advisory size, split skewed partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, read from ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own: on a cluster a
    machine-local folder is invisible to the other executors and dies with its
    machine.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="tidyspark-")
    spark.conf.set(CHECKPOINT_KEY, folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, one per call."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in reliable storage and read it from there.

    A lost executor then costs a re-read, not a recomputation, and the values
    seen by two later jobs are the same.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def keep_table(df: DataFrame) -> DataFrame:
    """Write ``df`` below the shared folder and read it back as a columnar table.

    Like ``cut_lineage``, for wide rows that several later jobs scan for a few
    columns each: those scans read only the columns they need. Columns are written
    by position, so any names will do.
    """
    path = scratch_path(df.sparkSession, "table")
    df.toDF(*[f"c{i}" for i in range(len(df.columns))]).write.parquet(path)
    return df.sparkSession.read.parquet(path).toDF(*df.columns)
