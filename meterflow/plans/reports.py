"""Serving reports over the result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterflow.functions import amounts, times
from meterflow.operators import alerts, ledger
from meterflow.operators.energy import grid_totals
from meterflow.operators.ordering import latest_windows, top
from meterflow.settings import NO_DATA_SECONDS


def with_load(windows: DataFrame) -> DataFrame:
    return windows.withColumn("avg_load_kw", amounts.avg_load_kw(
        F.col("total_consumption_kwh"), F.col("window_start"), F.col("window_end")))


METRIC_COLUMNS = ["window_start", "window_end", "grid_zone", "total_consumption_kwh",
                  "total_solar_kwh", "renewable_pct", "active_meters", "avg_load_kw", "updated_at"]


def zones(windows: DataFrame, include_open: bool = False) -> DataFrame:
    """Newest window per zone with its mean load."""
    return with_load(latest_windows(windows, not include_open)).select(*METRIC_COLUMNS)


def zones_total(windows: DataFrame, include_open: bool = False) -> DataFrame:
    return grid_totals(latest_windows(windows, not include_open)).withColumn(
        "window_complete", F.lit(not include_open))


def latest_sum(windows: DataFrame) -> DataFrame:
    """Meters active in the newest complete windows."""
    return latest_windows(windows).agg(F.sum("active_meters").alias("active_meters"))


def zone_history(windows: DataFrame, grid_zone: str, limit: int = 24) -> DataFrame:
    """A zone's newest windows, newest first."""
    if limit < 1:
        raise ValueError("at least one window must be asked for")
    chosen = windows.where(F.col("grid_zone") == grid_zone)
    return with_load(top(chosen, [F.col("window_start").desc()], limit)).select(*METRIC_COLUMNS)


def zone_status(windows: DataFrame, configured: DataFrame, asked: DataFrame) -> DataFrame:
    """Asked zones: unknown ones are flagged, known ones without windows are not an error."""
    counted = windows.groupBy("grid_zone").agg(F.count(F.lit(1)).alias("windows"))
    known = configured.select("grid_zone", F.lit(True).alias("is_known"))
    joined = asked.join(known, "grid_zone", "left").join(counted, "grid_zone", "left")
    return joined.select(
        "grid_zone", F.coalesce("is_known", F.lit(False)).alias("is_known"),
        F.coalesce("windows", F.lit(0)).alias("windows"),
        F.col("windows").isNotNull().alias("has_rows"),
    )


def zone_series(windows: DataFrame, start: Column, end: Column) -> DataFrame:
    """Share and consumption per zone at write time, within a range."""
    return windows.where(F.col("updated_at").between(start, end)).select(
        F.col("updated_at").alias("time"), "grid_zone", "renewable_pct", "total_consumption_kwh")


def health(windows: DataFrame, configured: DataFrame, now: Column,
           limit_seconds: int = NO_DATA_SECONDS) -> DataFrame:
    """One row about freshness, also when there are no windows yet."""
    state = windows.agg(
        F.count(F.lit(1)).alias("windows_stored"),
        F.count_distinct("grid_zone").alias("zones_reporting"),
        F.max("window_start").alias("newest_window_start"),
        F.max("updated_at").alias("last_write"),
    )
    micros = F.timestamp_diff("MICROSECOND", F.col("last_write"), now)
    age = F.round(micros.cast("decimal(18,0)") / 1_000_000, 1).cast("decimal(18,1)")
    fresh = F.coalesce(micros <= limit_seconds * 1_000_000, F.lit(False))
    return state.select(
        F.when(fresh, "ok").otherwise("degraded").alias("status"), fresh.alias("data_fresh"),
        age.alias("seconds_since_last_write"),
        F.lit(limit_seconds).cast("bigint").alias("freshness_threshold_seconds"),
        "windows_stored", "zones_reporting", "newest_window_start",
        configured.agg(F.count(F.lit(1))).scalar().alias("zones_configured"),
    )


def metric_rows(windows: DataFrame, log: DataFrame, runs: DataFrame, now: Column,
                batch_component: str) -> DataFrame:
    """Everything a scraper reads, in long form: (name, label, value)."""
    latest = with_load(latest_windows(windows))
    gauges = {"zone_renewable_pct": "renewable_pct", "zone_consumption_kwh": "total_consumption_kwh",
              "zone_solar_kwh": "total_solar_kwh", "zone_active_meters": "active_meters",
              "zone_avg_load_kw": "avg_load_kw"}
    wide = latest.select("grid_zone", *[F.col(c).cast("double").alias(n) for n, c in gauges.items()])
    per_zone = wide.unpivot(["grid_zone"], list(gauges), "name", "value").select(
        "name", F.col("grid_zone").alias("label"), "value")
    lag = windows.agg(F.coalesce(
        F.timestamp_diff("SECOND", F.max("updated_at"), now).cast("double"), F.lit(0.0))
        .alias("value")).select(F.lit("serving_lag_seconds").alias("name"),
                                F.lit("").alias("label"), "value")
    raised = alerts.counts(log).select(
        F.lit("alerts").alias("name"), F.concat_ws("/", "rule", "level").alias("label"),
        F.col("total").cast("double").alias("value"))
    by_state = ledger.counts(runs).select(
        F.lit("pipeline_runs").alias("name"), F.concat_ws("/", "component", "status").alias("label"),
        F.col("runs").cast("double").alias("value"))
    duration = ledger.last_success_seconds(runs.where(F.col("component") == batch_component)).select(
        F.lit("batch_last_duration_seconds").alias("name"), F.col("component").alias("label"),
        F.col("seconds").cast("double").alias("value"))
    return per_zone.unionByName(lag).unionByName(raised).unionByName(by_state).unionByName(duration)


def status_bands(windows: DataFrame, log: DataFrame, now: Column) -> DataFrame:
    """Colour of each panel: zone share, write lag, number of alerts. The steps are fixed values."""
    per_zone = latest_windows(windows).select(
        F.concat(F.lit("renewable/"), F.col("grid_zone")).alias("panel"),
        amounts.band(F.col("renewable_pct").cast("double"), (15.0, "green"), base="red").alias("band"))
    lag = windows.agg(F.timestamp_diff("SECOND", F.max("updated_at"), now).alias("s")).select(
        F.lit("lag").alias("panel"),
        amounts.band(F.col("s"), (30, "orange"), (60, "red"), base="green").alias("band"))
    raised = log.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("alerts").alias("panel"),
        amounts.band(F.col("n"), (1, "orange"), base="green").alias("band"))
    return per_zone.unionByName(lag).unionByName(raised)


def simulated_clock(windows: DataFrame, timezone: str) -> DataFrame:
    newest = windows.agg(F.max("window_start").alias("w"))
    return newest.select(times.local_text("w", timezone).alias("local_window"))


def throughput(readings: DataFrame) -> DataFrame:
    """Per arrival minute: events and late events per second."""
    late = F.col("ingested_at") > F.col("timestamp")
    per_minute = readings.groupBy(F.window("ingested_at", "1 minute").alias("w")).agg(
        F.count(F.lit(1)).alias("events"), F.count_if(late).alias("late"))
    return per_minute.select(F.col("w.start").alias("minute"), "events", "late",
                             (F.col("events") / F.lit(60.0)).alias("events_per_second"),
                             (F.col("late") / F.lit(60.0)).alias("late_per_second"))


def table_counts(**tables: DataFrame) -> DataFrame:
    """Row counts of several tables in one row."""
    spark = next(iter(tables.values())).sparkSession
    one = spark.range(1)
    return one.select(*[t.agg(F.count(F.lit(1))).scalar().alias(n) for n, t in tables.items()])


def firing_count(conditions: DataFrame) -> DataFrame:
    """Number of different conditions with at least one row; 0 when nothing fires."""
    return conditions.agg(F.count_distinct("condition").alias("firing"))
