"""Rates of counters that start again from zero when their process does.

A counter's samples are cumulative. What it rose by between two samples is their
difference, or the later sample itself where the counter has begun anew. Over a range, the
rises after the first sample are added and extended to the ends of the range, as far as the
spacing of the samples allows and for a counter not below zero.

Samples are compared with the one before inside days, with one line per day for the seams,
and reduced to one line per series and step before ranges, which overlap, are made of them.
A series with very many samples is never sorted as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterflow.operators.ordering import previous_in_order

_EPOCH = "1970-01-01 00:00:00"


def _micros(time: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast("timestamp_ntz"), time)


def over_ranges(samples: DataFrame, by: list[str], time: str, value: str, range_seconds: int, step_seconds: int,
                counter: bool = True) -> DataFrame:
    """Per series and evaluation time, a multiple of the step: samples in (at - range, at],
    resets among them, ``increase`` (of a gauge, with ``counter=False``, the difference) and
    ``per_second``. Ranges with fewer than two samples give no row; of several samples at
    one time the highest counts.
    """
    if range_seconds % step_seconds:
        raise ValueError("the range must be a multiple of the step")
    once = samples.groupBy(*by, F.col(time).alias("at")).agg(F.max(value).cast("double").alias("value"))
    seen = previous_in_order(once.withColumn("day", F.to_date("at")), by, "at", "value", "day")
    again = F.col("value") < F.col("previous") if counter else F.lit(False)
    rise = F.when(again, F.col("value")).otherwise(F.col("value") - F.col("previous"))
    step = step_seconds * 1_000_000
    lined = seen.select(*by, _micros(F.col("at")).alias("t"), "value", rise.alias("rise"), F.coalesce(again, F.lit(False)).alias("reset")) \
        .withColumn("step", F.ceil(F.col("t") / F.lit(step)).cast("long"))
    start = F.struct(F.coalesce("rise", F.lit(0.0)).alias("rise"), "value", F.col("reset").cast("int").alias("reset"))
    lines = lined.groupBy(*by, "step").agg(
        F.count(F.lit(1)).alias("n"), F.min("t").alias("first"), F.max("t").alias("last"),
        F.sum(F.coalesce("rise", F.lit(0.0))).alias("rises"), F.count_if("reset").alias("resets"), F.min_by(start, "t").alias("start"))
    ahead = F.explode(F.sequence(F.col("step"), F.col("step") + range_seconds // step_seconds - 1))
    ranges = lines.withColumn("step", ahead).groupBy(*by, "step").agg(
        F.sum("n").alias("samples"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.sum("rises").alias("rises"), F.sum("resets").alias("resets"), F.min_by("start", "first").alias("start")).where("samples > 1")
    return _extended(ranges, by, step, range_seconds, counter)


def _extended(ranges: DataFrame, by: list[str], step: int, range_seconds: int, counter: bool) -> DataFrame:
    """The rise between first and last sample, extended towards the ends of the range: up to
    an end that is at most 1.1 spacings away, else by half a spacing."""
    end = F.col("step") * step
    span = (F.col("last") - F.col("first")) / F.lit(1e6)
    before = (F.col("first") - (end - range_seconds * 1_000_000)) / F.lit(1e6)
    told = ranges.select(*by, "step", "samples", (F.col("resets") - F.col("start.reset")).alias("resets"),
                         (F.col("rises") - F.col("start.rise")).alias("rise"), F.col("start.value").alias("value"),
                         span.alias("span"), before.alias("before"), ((end - F.col("last")) / F.lit(1e6)).alias("after"))
    told = told.withColumn("gap", F.col("span") / (F.col("samples") - 1))

    def reach(side: str) -> Column:
        return F.when(F.col(side) >= F.col("gap") * 1.1, F.col("gap") / 2).otherwise(F.col(side))

    front = reach("before")
    if counter:
        front = F.when(F.col("rise") > 0, F.least(front, F.col("span") * (F.col("value") / F.col("rise")))).otherwise(front)
    increase = F.col("rise") * ((F.col("span") + front + reach("after")) / F.col("span"))
    at = F.timestamp_add("MICROSECOND", F.col("step") * step, F.lit(_EPOCH).cast("timestamp_ntz"))
    return told.select(*by, at.alias("at"), "samples", "resets", increase.alias("increase")).withColumn(
        "per_second", F.col("increase") / range_seconds)
