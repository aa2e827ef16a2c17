"""Streaming sources of raw records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_options(bootstrap: str, topic: str, start: str = "earliest", **extra) -> dict:
    """Options for ``format("kafka")``; a checkpoint overrides ``start`` on a restart.

    Offsets that the broker has expired are tolerated, since the store keeps them.
    """
    if start not in ("earliest", "latest"):
        raise ValueError(f"start must be 'earliest' or 'latest', not {start!r}")
    return {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
            "startingOffsets": start, "failOnDataLoss": "false", **extra}


def kafka_records(spark: SparkSession, options: dict) -> DataFrame:
    """Raw records of a topic. Needs Spark's Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**options).load()


def file_records(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Raw records from text files, one JSON value per line, taken as files arrive."""
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def trigger(once: bool, seconds: int) -> dict:
    """Take what is there and stop, or run a micro-batch every few seconds."""
    return {"availableNow": True} if once else {"processingTime": f"{seconds} seconds"}
