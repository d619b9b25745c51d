"""Session settings. On a cluster the caller brings its own session; the jobs read
their settings from it and set none."""

from __future__ import annotations

import tempfile
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # AQE sizes reduce partitions, splits skewed join partitions and picks broadcast
    # joins from measured shuffle sizes, so no size is fixed in the jobs themselves.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", memory: str = "8g", **extra: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("trialmetrics")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    A temporary folder stands in for it only in local mode, where one machine is all there is.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="run-")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder with all it holds, wherever the session's file systems keep it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of the written table.

    Used where several jobs need the same resolved rows. Unlike a cache it survives the
    loss of executors, because the files are not held by them.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
