"""Zone rules over finished windows, and the alert log built from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterflow.functions import amounts, times
from meterflow.settings import AlertThresholds, WINDOW_MINUTES

# Rule names and level as consumers of the log know them.
LOW_RENEWABLE = "low_renewable_contribution"
ZONE_OVERLOAD = "zone_overload"
WARN = "WARN"

IDENTITY = ["rule", "grid_zone", "window_start"]


def _text(value: Column, places: int) -> Column:
    return F.round(value.cast("decimal(28,10)"), places).cast(f"decimal(18,{places})").cast("string")


def rules(limits: AlertThresholds, timezone: str, window_minutes: int) -> list[tuple]:
    """The rules as (name, level, condition, message): a new rule is one more tuple.

    The message texts are fixed values, as readers of the log know them.
    """
    local = times.to_local("window_start", timezone)
    kw = amounts.mean_kw_per_meter(F.col("total_consumption_kwh"), window_minutes,
                                   F.col("active_meters"))
    kw_exact = (F.col("total_consumption_kwh").cast(amounts.KWH) * 60
                / F.nullif(F.col("active_meters") * window_minutes, F.lit(0)).cast("decimal(12,0)"))
    return [
        (
            LOW_RENEWABLE, WARN,
            times.hour_in(local, limits.check_from_hour, limits.check_to_hour)
            & (F.col("renewable_pct") < F.lit(limits.low_renewable_pct)),
            F.concat(F.lit("Low renewable contribution, "), F.col("grid_zone"), F.lit(": "),
                     _text(F.col("renewable_pct"), 1),
                     F.lit(f"% (floor {limits.low_renewable_pct:.0f}%) at "),
                     F.date_format(local, "yyyy-MM-dd HH:mm"), F.lit(" simulated")),
        ),
        (
            ZONE_OVERLOAD, WARN,
            kw > F.lit(limits.overload_kw_per_meter),
            F.concat(F.lit("Zone load high, "), F.col("grid_zone"), F.lit(": "),
                     _text(kw_exact, 2), F.lit(" kW/meter across "),
                     F.col("active_meters").cast("string"),
                     F.lit(f" meters (ceiling {limits.overload_kw_per_meter:.2f})")),
        ),
    ]


def evaluate(windows: DataFrame, timezone: str, limits: AlertThresholds = AlertThresholds(),
             window_minutes: int = WINDOW_MINUTES, keep: list[str] | None = None) -> DataFrame:
    """One row per breached rule and window, in one pass over the windows; ``keep`` names
    columns to carry on."""
    breaches = [
        F.when(condition, F.struct(F.lit(level).alias("level"), F.lit(name).alias("rule"),
                                   message.alias("message")))
        for name, level, condition, message in rules(limits, timezone, window_minutes)
    ]
    found = windows.withColumn("_breach", F.explode(F.filter(F.array(*breaches),
                                                             lambda b: b.isNotNull())))
    columns = ["window_start", "grid_zone", "_breach.level", "_breach.rule", "_breach.message", *(keep or [])]
    if "updated_at" in windows.columns:
        columns.append(F.col("updated_at").alias("ts"))
    return found.select(*columns)


def not_yet_raised(alerts: DataFrame, log: DataFrame) -> DataFrame:
    """Alerts whose condition (rule, zone, window) is not in the log."""
    return alerts.join(log.select(*IDENTITY), IDENTITY, "left_anti")


def recent(log: DataFrame, limit: int = 50, rule: str | None = None,
           grid_zone: str | None = None) -> DataFrame:
    """Newest alerts, optionally of one rule or zone."""
    chosen = log
    if rule is not None:
        chosen = chosen.where(F.col("rule") == rule)
    if grid_zone is not None:
        chosen = chosen.where(F.col("grid_zone") == grid_zone)
    return chosen.orderBy(F.col("ts").desc(), "rule", "grid_zone", "window_start").limit(limit)


def counts(log: DataFrame) -> DataFrame:
    return log.groupBy("rule", "level").agg(F.count(F.lit(1)).alias("total"))


def latest_message(log: DataFrame) -> DataFrame:
    """Per rule and level: number, newest time and the newest message."""
    newest = F.struct("ts", "window_start", "grid_zone")
    return log.groupBy("rule", "level").agg(
        F.count(F.lit(1)).alias("total"), F.max("ts").alias("newest"),
        F.max_by("message", newest).alias("latest_message"),
    )


def in_range(log: DataFrame, start, end) -> DataFrame:
    return log.where(F.col("ts").between(start, end)).agg(F.count(F.lit(1)).alias("alerts"))
