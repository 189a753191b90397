"""Session helpers: a local session for tests and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str = "8", memory: str = "8g", app: str = "tillage") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local session may fall back on a folder of this machine; on a cluster a
    missing setting is an error, because executors do not share the driver's disk.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return os.path.join(tempfile.gettempdir(), "tillage-shared")
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path of its own for one run of one job, so runs never overwrite each other."""
    return f"{shared_folder(spark)}/tillage/{name}-{uuid.uuid4().hex}"


def materialize(df, name: str, spread: bool = False):
    """Write ``df`` once to the shared folder and read it back: cuts the lineage and
    survives the loss of any executor. Its true size is known from then on, so a join with
    it broadcasts only what is small.

    With ``spread``, a table of fewer file splits than cores is dealt out to all cores, for the
    jobs that spend their time on the rows and not on reading them. A larger table is not: each
    reader would send all of it through a shuffle.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    if spread and back.rdd.getNumPartitions() < min(task_count(spark), spark.sparkContext.defaultParallelism):
        return back.repartition(task_count(spark))
    return back


def task_count(spark: SparkSession) -> int:
    """Tasks of a shuffle, as the session sets them."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
