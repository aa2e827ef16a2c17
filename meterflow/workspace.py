"""Where jobs keep tables and checkpoints between steps."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder for one use below the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir``. A local session without that setting,
    as in tests, gets one of its own; any other session must name one, since executors
    cannot see each other's disks. What lies in it goes when the session's JVM ends.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="meterflow-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/meterflow/{name}-{uuid.uuid4().hex}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(place)
    files.deleteOnExit(place)
    return path


def materialised(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back.

    For a derived table that one report reads several times: the tables it comes from are
    then scanned once. Being plain files it outlives lost executors.
    """
    path = f"{shared_folder(df.sparkSession, name)}/table"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, on any file system that Spark reaches; sorted."""
    files, place = _place(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    files, place = _place(spark, path)
    files.delete(place, True)
