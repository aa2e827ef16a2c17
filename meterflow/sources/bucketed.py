"""Readings kept in buckets of their household, so that usage and bills move no reading.

A table is partitioned by day and, within the day, bucketed by a hash of the household. One
shuffle when it is written takes the place of those of every later dedupe, usage and bill:
they all group by the household, and find its rows in one bucket. Costs and gains are those
of bucketing: a bucket is one task, so there should be several times as many as cores, and a
household with a large share of all readings is better read from the plain store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from meterflow.operators import dedupe, energy

BUCKET_BY = "household_id"
#: A household's meters are its own, so a reading's key within the bucket has it too.
BUCKETED_KEY = ("household_id", "meter_id", "timestamp")


def write_bucketed(readings: DataFrame, table: str, path: str | None = None, buckets: int = 256) -> None:
    """Writes readings as a bucketed table of the session's catalogue, one file per day and bucket."""
    writer = (readings.repartition(buckets, BUCKET_BY).write.mode("overwrite").partitionBy("sim_day")
              .bucketBy(buckets, BUCKET_BY).sortBy(*BUCKETED_KEY))
    (writer.option("path", path) if path else writer).saveAsTable(table)


def unique_readings(spark: SparkSession, table: str) -> DataFrame:
    """The table's readings without replays, each bucket by itself."""
    return dedupe.dedupe_readings(spark.table(table), key=BUCKETED_KEY)


def daily_usage(spark: SparkSession, table: str) -> DataFrame:
    """Exact usage per day and household from a bucketed table, without an exchange."""
    return energy.daily_usage(unique_readings(spark, table))
