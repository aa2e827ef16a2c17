"""Whether a checkpoint fits the settings of the job that is about to go on from it.

Spark resumes a query from state that other settings have made without a word: windows of
another length are then counted beside the old ones. A job writes down its settings once,
beside the checkpoint's own files, and they are compared when it is started again. What an
older checkpoint, which has no such record, was made with is read from its state: the
windows it holds and the time it keeps what it has seen.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterflow.functions import times
from meterflow.settings import StreamSettings
from meterflow.workspace import children

COMPARED = ("timezone", "window_minutes", "watermark_minutes")
RESULT = "check string, found string, expected string, fits boolean"


# -- the record ----------------------------------------------------------------

def record(spark: SparkSession, checkpoint: str) -> dict | None:
    """When the checkpoint was made and with which settings, as its job wrote it down."""
    path = f"{checkpoint.rstrip('/')}/job"
    if not any(f.startswith("part-") for f in children(spark, path)):
        return None
    return json.loads(spark.read.text(path).first()[0])


def admit(spark: SparkSession, checkpoint: str, settings: StreamSettings) -> dict:
    """The checkpoint's record, written now if there is none; refuses settings that don't fit."""
    known = record(spark, checkpoint)
    if known is None:
        unfit = fitness(spark, checkpoint, settings).where("not fits").collect() if children(spark, f"{checkpoint}/state") else []
        found = [(r.check, r.found, r.expected) for r in unfit]
    else:
        found = [(name, known[name], getattr(settings, name)) for name in COMPARED if known[name] != getattr(settings, name)]
    if found:
        told = "; ".join(f"{check} was {was}, is {now}" for check, was, now in found)
        raise ValueError(f"the checkpoint {checkpoint} was made with other settings: {told}; begin with a new one")
    if known is None:
        made = int(time.time() * 1000) if not children(spark, f"{checkpoint}/metadata") else _since(spark, checkpoint)
        known = {"made": made, **{name: getattr(settings, name) for name in COMPARED}}
        spark.createDataFrame([(json.dumps(known),)], "value string").coalesce(1).write.mode("overwrite").text(f"{checkpoint}/job")
    return known


def _since(spark: SparkSession, checkpoint: str) -> int:
    found = spark.read.format("binaryFile").load(f"{checkpoint.rstrip('/')}/metadata")
    return found.select(F.unix_millis("modificationTime")).first()[0]


def made(spark: SparkSession, checkpoint: str) -> int:
    """When the checkpoint was made, in milliseconds: as recorded, which a copy keeps, or as
    its files' times say."""
    known = record(spark, checkpoint)
    return known["made"] if known else _since(spark, checkpoint)


# -- the state -----------------------------------------------------------------

def operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful steps of a checkpoint: operator_id, operator, partitions, last_batch."""
    found = spark.read.format("state-metadata").load(checkpoint)
    return found.select(F.col("operatorId").alias("operator_id"), F.col("operatorName").alias("operator"),
                        F.col("numPartitions").alias("partitions"), F.col("maxBatchId").alias("last_batch"))


def state(spark: SparkSession, checkpoint: str, operator_id: int) -> DataFrame:
    """The rows that a stateful step holds: key, value and partition_id."""
    return spark.read.format("statestore").option("operatorId", operator_id).load(checkpoint)


def state_rows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """operator and rows of every stateful step; one scan of each step's state."""
    parts = [state(spark, checkpoint, r.operator_id).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(r.operator).alias("operator"), "rows")
             for r in operators(spark, checkpoint).collect()]
    frame = parts[0]
    for part in parts[1:]:
        frame = frame.unionByName(part)
    return frame


def fitness(spark: SparkSession, checkpoint: str, settings: StreamSettings, steps: list[str] | None = None) -> DataFrame:
    """check, found, expected, fits: what the state of a checkpoint tells of the settings it
    was made with. A check whose state is empty has nothing to tell and isn't listed.

    ``steps`` names the stateful steps that the job has, the last one first.
    """
    known = operators(spark, checkpoint).orderBy("operator_id").collect()
    checks = []
    if steps is not None:
        told = ", ".join(r.operator for r in known)
        checks.append(spark.createDataFrame([("steps", told, ", ".join(steps), told == ", ".join(steps))], RESULT))
    length = settings.window_minutes
    shift = times.window_shift_minutes(settings.timezone, length)
    for r in known:
        held = state(spark, checkpoint, r.operator_id)
        keys = held.schema["key"].dataType.names
        if "window" in keys:
            start = F.unix_seconds("key.window.start")
            minutes = ((F.unix_seconds("key.window.end") - start) / 60).cast("long")
            checks += [_told(held.select(minutes.alias("v")), "window_minutes", length),
                       _told(held.select(F.pmod((start / 60).cast("long"), F.lit(length)).alias("v")), "window start", shift % length)]
        elif r.operator == "dedupeWithinWatermark" and "timestamp" in keys:
            kept_for = (F.col("value.expiresAtMicros") - F.unix_micros("key.timestamp")) / 60_000_000
            checks.append(_told(held.select(kept_for.cast("long").alias("v")), "watermark_minutes", settings.watermark_minutes))
    frame = spark.createDataFrame([], RESULT)
    for check in checks:
        frame = frame.unionByName(check)
    return frame


def _told(values: DataFrame, check: str, expected: int) -> DataFrame:
    """One line on the values a state holds: all of them must be the expected one."""
    seen = values.agg(F.min("v").alias("low"), F.max("v").alias("high")).where("low is not null")
    found = F.when(F.col("low") == F.col("high"), F.col("low").cast("string")).otherwise(F.concat_ws(" to ", "low", "high"))
    return seen.select(F.lit(check).alias("check"), found.alias("found"), F.lit(str(expected)).alias("expected"),
                       ((F.col("low") == expected) & (F.col("high") == expected)).alias("fits"))
