"""Session helpers: one place that decides where intermediate tables may live."""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "tabwright", cpus: str | int = "*", **conf) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TABWRIGHT_DRIVER_MEMORY", "12g"))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local master may fall back to a temporary folder: there the driver and the
    executors are one process. Anywhere else a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
    return os.path.join(tempfile.gettempdir(), "tabwright-shared")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def few_tasks(df: DataFrame, per_core: int = 3) -> DataFrame:
    """Three tasks per core (`per_core`) or a 64th of the input's tasks, whichever is more, without a shuffle.

    For jobs whose tasks each emit a block of partial sums: what is shuffled grows with the number
    of tasks, so several input splits are read by one longer task; the tasks still grow with the input.
    """
    most = max(per_core * df.sparkSession.sparkContext.defaultParallelism, math.ceil(df.rdd.getNumPartitions() / 64))
    return df.coalesce(most)


def materialize(df: DataFrame, name: str, rows_per_file: int = 0) -> DataFrame:
    """Write once to the shared folder and read back.

    Used for a frame that several later jobs read: survives the loss of an executor, cuts the
    lineage, and keeps column pruning and filter pushdown for every reader. A file gets at most
    `rows_per_file` rows, if given.
    """
    path = new_path(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
