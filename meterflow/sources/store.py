"""The append-only Parquet store of readings, partitioned by day and zone."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterflow.operators.dedupe import dedupe_readings

PARTITIONS = ["sim_day", "grid_zone"]
DATA_COLUMNS = {
    "meter_id", "household_id", "power_consumption_kwh", "solar_generation_kwh",
    "timestamp", "ingested_at",
}


def append_readings(readings: DataFrame, path: str) -> None:
    """Adds readings as a batch of their own, never replaced."""
    write_batch(readings, path, f"append-{uuid.uuid4().hex}")


def write_batch(readings: DataFrame, path: str, batch: str) -> None:
    """Writes a batch so that writing it again changes nothing.

    Every store has this one layout: below day and zone lies a folder per batch, and only
    the folders of this batch are overwritten. The rebalance hint lets adaptive execution
    merge small partitions and split a day and zone with a large share of the rows.
    """
    marked = readings.withColumn("batch", F.lit(batch)).hint("rebalance", *PARTITIONS)
    (marked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*PARTITIONS, "batch").parquet(path))


def read_readings(spark: SparkSession, path: str, sim_day=None, dedupe: bool = True) -> DataFrame:
    """Stored readings of all days or one, duplicates removed.

    The day filter sits on the partition column ahead of the dedupe and reads one folder.
    """
    stored = spark.read.parquet(path).withColumn("sim_day", F.col("sim_day").cast("date"))
    if sim_day is not None:
        stored = stored.where(F.col("sim_day") == F.lit(sim_day).cast("date"))
    return dedupe_readings(stored) if dedupe else stored


def stored_days(spark: SparkSession, path: str) -> DataFrame:
    """Days in the store, newest first, from the names of its folders: no file is opened."""
    days = list_files(spark, path, "*.parquet").select(partition_value(F.col("path"), "sim_day").cast("date").alias("sim_day"))
    return days.distinct().orderBy(F.col("sim_day").desc())


def newest_event(spark: SparkSession, path: str) -> Column:
    """Newest event time as a scalar: it lies in the newest day, so one folder is read."""
    stored = read_readings(spark, path, dedupe=False)
    newest_day = stored_days(spark, path).agg(F.max("sim_day")).scalar()
    return stored.where(F.col("sim_day") == newest_day).agg(F.max("timestamp")).scalar()


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Refuses an empty input: reads at most one row to find out."""
    if df.isEmpty():
        raise ValueError(f"{what} holds no rows")
    return df


def compact_days(spark: SparkSession, path: str, target: str, days: list) -> None:
    """Rewrites days as one batch into another store, few files per partition."""
    stored = read_readings(spark, path, dedupe=False)
    chosen = stored.where(F.col("sim_day").isin(*[F.lit(d).cast("date") for d in days]))
    write_batch(dedupe_readings(chosen.drop("batch")), target, "compacted")


def partition_value(file_path: Column, column: str) -> Column:
    """Value of a ``column=value`` level in a path; null where there is none."""
    value = F.regexp_extract(file_path, f"/{column}=([^/]+)/", 1)
    return F.nullif(F.url_decode(value), F.lit(""))


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files below a folder with their size; contents are not read."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", pattern).load(path))
    return found.select("path", "length", "modificationTime")


def layout_check(spark: SparkSession, path: str, partitions: list[str] | None = None) -> DataFrame:
    """Parquet files of a store with their partition values and whether the path fits.

    Marker and hidden files are not listed, as Spark's readers ignore them too.
    """
    levels = partitions or PARTITIONS
    files = list_files(spark, path, "*.parquet")
    inside = F.regexp_extract("path", r"/((?:[^/]+=[^/]+/)*)[^/]+$", 1)
    expected = "^" + "".join(f"{level}=[^/]+/" for level in levels) + "(?:batch=[^/]+/)?$"
    return files.select(
        "path", "length", *[partition_value(F.col("path"), c).alias(c) for c in levels],
        inside.rlike(expected).alias("fits"),
    )


def store_summary(spark: SparkSession, path: str) -> DataFrame:
    """Files, rows and distinct readings of a store, as one row."""
    stored = spark.read.parquet(path)
    per_key = stored.groupBy("meter_id", "timestamp").agg(F.count(F.lit(1)).alias("n"))
    keys = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("rows"),
                       F.count(F.lit(1)).alias("distinct_readings"))
    files = list_files(spark, path, "*.parquet").agg(F.count(F.lit(1))).scalar()
    return keys.withColumn("files", files)
