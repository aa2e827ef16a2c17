"""Energy aggregates. One definition serves the stream and the batch jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterflow.functions import amounts, times
from meterflow.operators.ordering import with_overall
from meterflow.settings import WINDOW_MINUTES

#: Size of a stored meter sketch: 2 to this power cells of at most a byte, 0.8 % standard error.
SKETCH_BITS = 14


def aggregate_energy(df: DataFrame, by: list, meters: str = "exact", rsd: float = 0.05,
                     extra: list[Column] | None = None) -> DataFrame:
    """Consumption, generation and number of meters over any grouping.

    ``meters="exact"`` counts distinct meters: Spark first groups by (keys, meter), so a
    group holding a large share of the rows is still split by meter. ``"approx"`` uses a
    HyperLogLog sketch of fixed size and is what an update-mode stream can carry.
    ``"sketch"`` does too and keeps the sketch as ``meters_sketch``, for ``rolled_up``; it
    counts exactly up to a thousand meters.
    """
    if meters == "exact":
        count = F.count_distinct("meter_id")
    elif meters == "approx":
        count = F.approx_count_distinct("meter_id", rsd)
    elif meters == "sketch":
        sketch = F.hll_sketch_agg("meter_id", F.lit(SKETCH_BITS))
        count, extra = F.hll_sketch_estimate(sketch), [*(extra or []), sketch.alias("meters_sketch")]
    else:
        raise ValueError(f"meters must be 'exact', 'approx' or 'sketch', not {meters!r}")
    return df.groupBy(*by).agg(
        amounts.sum_kwh("power_consumption_kwh").alias("total_consumption_kwh"),
        amounts.sum_kwh("solar_generation_kwh").alias("total_solar_kwh"),
        count.alias("active_meters"),
        *(extra or []),
    )


def with_renewable_pct(df: DataFrame) -> DataFrame:
    """Solar share of consumption, from the already rounded totals."""
    return df.withColumn(
        "renewable_pct",
        amounts.renewable_pct(F.col("total_solar_kwh"), F.col("total_consumption_kwh")),
    )


def zone_windows(readings: DataFrame, timezone: str, window_minutes: int = WINDOW_MINUTES,
                 meters: str = "exact") -> DataFrame:
    """Tumbling windows per zone on the zone's local clock, from stored readings.

    Windows are cut on local wall-clock time, which needs no start offset and also holds
    for zones with daylight saving. ``updated_at`` is the last arrival in the window.
    """
    length = f"{window_minutes} minutes"
    local = readings.withColumn("local_time", times.to_local("timestamp", timezone))
    grouped = aggregate_energy(
        local, [F.window("local_time", length).alias("w"), "grid_zone"], meters,
        extra=[F.max("ingested_at").alias("updated_at"), F.count(F.lit(1)).alias("readings")],
    )
    return with_renewable_pct(grouped).select(
        times.to_utc("w.start", timezone).alias("window_start"),
        times.to_utc("w.end", timezone).alias("window_end"),
        "grid_zone", "total_consumption_kwh", "total_solar_kwh", "renewable_pct",
        "active_meters", "updated_at", "readings", *(["meters_sketch"] if meters == "sketch" else []),
    )


def rolled_up(windows: DataFrame, by: list) -> DataFrame:
    """Windows with meter sketches put together over any coarser grouping, without readings.

    Energy adds up exactly; a meter seen in several windows is counted once, as the union of
    their sketches tells. The sketch stays, so that the result can be rolled up again.
    """
    sketch = F.hll_union_agg("meters_sketch")
    totals = windows.groupBy(*by).agg(
        F.sum("total_consumption_kwh").cast(amounts.KWH).alias("total_consumption_kwh"),
        F.sum("total_solar_kwh").cast(amounts.KWH).alias("total_solar_kwh"),
        F.hll_sketch_estimate(sketch).alias("active_meters"), sketch.alias("meters_sketch"))
    return with_renewable_pct(totals)


def daily_usage(readings: DataFrame) -> DataFrame:
    """Exact usage per day and household, all days in one plan.

    The zone stays in the key: a household seen in two zones gives two rows, which
    ``billing.two_zone_households`` reports.
    """
    return aggregate_energy(readings, ["sim_day", "household_id", "grid_zone"])


def windows_of_day(windows: DataFrame, day, timezone: str) -> DataFrame:
    """Windows that start on a local day, as a half-open range on the stored column."""
    start = times.to_utc(F.lit(day).cast("date").cast("timestamp_ntz"), timezone)
    end = times.to_utc(F.date_add(F.lit(day).cast("date"), 1).cast("timestamp_ntz"), timezone)
    return windows.where((F.col("window_start") >= start) & (F.col("window_start") < end))


def partition_counts(readings: DataFrame) -> DataFrame:
    return readings.groupBy("sim_day", "grid_zone").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("meter_id").alias("meters")
    )


def zone_day_totals(readings: DataFrame, kwh_places: int = 3, share_places: int = 1) -> DataFrame:
    """Zone totals of each day with first and last event; share is null without use."""
    totals = aggregate_energy(
        readings, ["sim_day", "grid_zone"],
        extra=[F.min("timestamp").alias("first_event"), F.max("timestamp").alias("last_event")],
    )
    kind = f"decimal(18,{kwh_places})"
    rounded = totals.select(
        "sim_day", "grid_zone",
        F.round("total_consumption_kwh", kwh_places).cast(kind).alias("consumption_kwh"),
        F.round("total_solar_kwh", kwh_places).cast(kind).alias("solar_kwh"),
        "active_meters", "first_event", "last_event",
    )
    return rounded.withColumn(
        "renewable_pct",
        amounts.share_pct(F.col("solar_kwh"), F.col("consumption_kwh"), share_places, empty=None),
    )


def stream_sample_summary(readings: DataFrame) -> DataFrame:
    """Per zone: events, meters, energy, share and the event-time span in minutes."""
    summary = aggregate_energy(
        readings, ["grid_zone"],
        extra=[F.count(F.lit(1)).alias("events"),
               F.min("timestamp").alias("first_event"), F.max("timestamp").alias("last_event")],
    )
    span = amounts.seconds_between(F.col("first_event"), F.col("last_event"))
    return summary.select(
        "grid_zone", "events", F.col("active_meters").alias("meters"),
        F.col("total_consumption_kwh").alias("kwh_used"),
        F.col("total_solar_kwh").alias("kwh_solar"),
        amounts.share_pct(F.col("total_solar_kwh"), F.col("total_consumption_kwh"), 1)
        .alias("renewable_pct"),
        "first_event", "last_event",
        F.round(span.cast("decimal(18,0)") / 60, 1).cast("decimal(18,1)").alias("span_minutes"),
    )


def grid_totals(windows: DataFrame) -> DataFrame:
    """Totals over a set of zone windows; the share comes from the totals."""
    return windows.agg(
        F.count(F.lit(1)).alias("zone_count"),
        F.coalesce(F.sum("total_consumption_kwh"), F.lit(0)).cast(amounts.KWH)
        .alias("grid_total_consumption_kwh"),
        F.coalesce(F.sum("total_solar_kwh"), F.lit(0)).cast(amounts.KWH)
        .alias("grid_total_solar_kwh"),
        F.sum("active_meters").alias("active_meters"),
    ).withColumn(
        "grid_renewable_pct",
        amounts.renewable_pct(F.col("grid_total_solar_kwh"), F.col("grid_total_consumption_kwh")),
    )


def closed_days(readings: DataFrame, timezone: str, watermark_minutes: int) -> DataFrame:
    """Stored days with a flag for days the watermark has fully passed.

    A day is closed when the newest event of the whole store, less the watermark, is at
    or after the day's end on the local clock.
    """
    per_day = readings.groupBy("sim_day").agg(
        F.count(F.lit(1)).alias("rows"), F.max("timestamp").alias("last_event")
    )
    seen = with_overall(per_day, newest_event=F.max("last_event"))
    day_end = times.to_utc(F.date_add("sim_day", 1).cast("timestamp_ntz"), timezone)
    passed = F.col("newest_event") - F.make_dt_interval(mins=F.lit(watermark_minutes))
    flagged = seen.select("sim_day", "rows", "last_event", (passed >= day_end).alias("is_closed"))
    newest_closed = F.max(F.when(F.col("is_closed"), F.col("sim_day")))
    return with_overall(flagged, billable_day=newest_closed)
