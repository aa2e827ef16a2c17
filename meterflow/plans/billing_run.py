"""A billing run of one stored day: gates, bills, report, ledger.

Only single values and a few names for messages come to the driver.
"""

from __future__ import annotations

import functools
from datetime import date, datetime, timezone as tz

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterflow.functions import times
from meterflow.operators import audit, billing, energy, ledger
from meterflow.settings import BillingTerms, TIMEZONE, WATERMARK_MINUTES
from meterflow.sources import reports, store, tariff_files
from meterflow.workspace import materialised

COMPONENT = "billing_batch"
EVENT = ("run_id string, component string, sim_day date, at timestamp_ntz, kind string, "
         "status string, rows_written bigint, notes string")


class RunRefused(ValueError):
    """The run must not write anything; the message says why."""


def closed_days(spark: SparkSession, path: str, timezone: str, watermark_minutes: int) -> DataFrame:
    """Stored days the watermark has fully passed, newest first."""
    passed = store.newest_event(spark, path) - F.make_dt_interval(mins=F.lit(watermark_minutes))
    day_end = times.to_utc(F.date_add("sim_day", 1).cast("timestamp_ntz"), timezone)
    return store.stored_days(spark, path).where(passed >= day_end)


def resolve_day(spark: SparkSession, path: str, requested: date | None = None,
                allow_open: bool = False, timezone: str = TIMEZONE,
                watermark_minutes: int = WATERMARK_MINUTES) -> date:
    """The day to bill: the newest closed one, or the one asked for if it is closed."""
    closed = closed_days(spark, path, timezone, watermark_minutes)
    if requested is None:
        newest = closed.first()
        if newest is None:
            raise RunRefused("no stored day has closed yet")
        return newest.sim_day
    if not allow_open and closed.where(F.col("sim_day") == F.lit(requested)).isEmpty():
        raise RunRefused(f"{requested} is still open or not stored; its bills would be too low")
    return requested


def findings(usage: DataFrame, tariff: DataFrame) -> DataFrame:
    """Every household that can't be billed rightly (refused), or looks odd (warning)."""
    found = {
        ("refused", "without a rate"): billing.unpriced(usage, tariff),
        ("refused", "with several rates"): billing.repeated_tariffs(tariff),
        ("refused", "in several zones"): billing.two_zone_households(usage),
        ("warning", "with other than one meter"): billing.multi_metered(usage),
    }
    rows = [df.select(F.lit(level).alias("level"), F.lit(what).alias("finding"), "sim_day", "household_id")
            for (level, what), df in found.items()]
    return functools.reduce(DataFrame.unionByName, rows)


def check(found: DataFrame) -> None:
    """Refuses a run that would bill a household wrongly; the whole list is in ``found``."""
    counts = found.where("level = 'refused'").groupBy("finding").agg(
        F.count(F.lit(1)).alias("n"), F.min("household_id").alias("first")).orderBy("finding").collect()
    if counts:
        raise RunRefused("households " + "; ".join(f"{r.finding}: {r.first} and {r.n - 1} more" for r in counts))


def write_bills(bills: DataFrame, path: str, run_id: str) -> None:
    """Replaces the days of these bills and no others, stamped with the run."""
    stamped = bills.select("*", F.lit(run_id).alias("run_id"),
                           times.instant_to_utc(F.current_timestamp()).alias("generated_at"))
    (stamped.hint("rebalance", "sim_day").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("sim_day").parquet(path))


def record(spark: SparkSession, path: str, run_id: str, kind: str, day: date | None = None,
           status: str | None = None, rows: int | None = None, notes: str | None = None,
           component: str = COMPONENT) -> None:
    """Appends one event to the ledger, of the billing run or of another component."""
    now = datetime.now(tz.utc).replace(tzinfo=None)
    line = (run_id, component, day, now, kind, status, rows, notes)
    spark.createDataFrame([line], EVENT).coalesce(1).write.mode("append").parquet(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return ledger.fold(spark.read.schema(EVENT).parquet(path))


def run(spark: SparkSession, store_path: str, tariff_path: str, bills_path: str, report_path: str,
        ledger_path: str, run_id: str, day: date | None = None, allow_open: bool = False,
        timezone: str = TIMEZONE, terms: BillingTerms = BillingTerms(),
        findings_path: str | None = None) -> DataFrame:
    """Bills one day and returns its summary; the ledger also shows a run that failed.

    All findings of the run, those that refuse it and warnings about meters and partial
    days, are a table under ``findings_path`` (beside the ledger by default).
    """
    chosen = resolve_day(spark, store_path, day, allow_open, timezone)
    record(spark, ledger_path, run_id, "start", chosen, notes=f"billing {chosen}")
    status, rows = "FAILED", 0
    try:
        readings = store.read_readings(spark, store_path, chosen)
        store.require_rows(readings, f"the store for {chosen}")
        tariff = tariff_files.read_day(spark, tariff_path, chosen)
        usage = materialised(energy.daily_usage(readings), "usage")
        found = f"{findings_path or ledger_path.rstrip('/') + '-findings'}/run_id={run_id}"
        findings(usage, tariff).write.mode("overwrite").parquet(found)
        check(spark.read.parquet(found))
        write_bills(billing.bills_from_usage(usage, tariff, terms), bills_path, run_id)
        written = read_bills(spark, bills_path).where(F.col("sim_day") == F.lit(chosen))
        configured = tariff.agg(F.count_distinct("household_id")).scalar()
        short = billing.partial_days(written, configured).select(
            F.lit("warning").alias("level"), F.concat_ws(" ", F.lit("billed"), "billed", F.lit("of"), "configured").alias("finding"),
            "sim_day", F.lit(None).cast("string").alias("household_id"))
        short.write.mode("append").parquet(found)
        reports.write_report(written, report_path)
        summary = billing.summarise(written)
        rows = written.count()
        status = "SUCCESS"
        return summary
    finally:
        record(spark, ledger_path, run_id, "finish", status=status, rows=rows)


def verify(spark: SparkSession, bills_path: str, ledger_path: str, day: date,
           configured_households: int) -> DataFrame:
    """Gate after a run: one line per check with expected, actual and verdict.

    Every household has a bill, amounts follow from usage and rate, none is impossible,
    and one run, the newest and successful, owns the day.
    """
    bills = read_bills(spark, bills_path).where(F.col("sim_day") == F.lit(day))
    runs = read_ledger(spark, ledger_path).where(F.col("sim_day") == F.lit(day))
    wrong = audit.verify_bills(bills).agg(F.count(F.lit(1)).alias("actual"))
    impossible = audit.impossible_bills(bills).agg(
        F.coalesce(F.sum("impossible"), F.lit(0)).alias("actual"))
    owned = audit.bill_ownership(bills, runs).agg(F.count_if(F.col("ok")).alias("actual"))
    billed = bills.agg(F.count(F.lit(1)).alias("actual"))
    lines = None
    for name, expected, found in (("households_billed", configured_households, billed),
                                  ("wrong_amounts", 0, wrong), ("impossible_bills", 0, impossible),
                                  ("owned_by_newest_run", 1, owned)):
        line = found.select(F.lit(name).alias("check"), F.lit(expected).cast("bigint").alias("expected"),
                            F.col("actual").cast("bigint").alias("actual"))
        lines = line if lines is None else lines.unionByName(line)
    return lines.withColumn("ok", F.col("expected") == F.col("actual"))


def read_bills(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("sim_day", F.col("sim_day").cast("date"))

