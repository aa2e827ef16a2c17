"""Checks that derive a result a second way and list every disagreement."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from meterflow.functions import amounts
from meterflow.operators import billing
from meterflow.operators.ordering import latest_per_group
from meterflow.settings import (BillingTerms, FRESHNESS_SLACK_SECONDS, KWH_TOLERANCE,
                                LAG_BUDGET_TRIGGERS, MONEY_TOLERANCE, NO_DATA_SECONDS,
                                RAW_TRIGGER_SECONDS, WINDOW_MINUTES)


def _differences(pairs: list[tuple[str, Column, Column, str]]) -> Column:
    """Array of the (field, stored, derived) triples that differ by more than a tolerance."""
    found = [
        F.when(
            F.abs(stored - derived) > F.lit(Decimal(tolerance)),
            F.struct(F.lit(name).alias("field"), stored.cast(amounts.KWH).alias("stored"),
                     derived.cast(amounts.KWH).alias("derived")),
        )
        for name, stored, derived, tolerance in pairs
    ]
    return F.filter(F.array(*found), lambda d: d.isNotNull())


def verify_bills(stored: DataFrame, terms: BillingTerms = BillingTerms(),
                 tolerance: str = MONEY_TOLERANCE) -> DataFrame:
    """Amounts re-derived from the stored usage and rate; one row per wrong field."""
    fields = ["net_kwh", "gross_amount", "subsidy_amount", "net_amount"]
    kept = stored.select("*", *[F.col(f).alias(f"_stored_{f}") for f in fields])
    again = billing.bill(kept, terms)
    pairs = [(f, F.col(f"_stored_{f}"), F.col(f), tolerance) for f in fields]
    return (
        again.select("sim_day", "household_id", F.explode(_differences(pairs)).alias("d"))
        .select("sim_day", "household_id", "d.*")
    )


def recompute_bills(stored: DataFrame, readings: DataFrame, tariff: DataFrame,
                    terms: BillingTerms = BillingTerms()) -> DataFrame:
    """Every stored bill against one worked out again from unique raw readings.

    ``readings`` must be deduplicated. Each bill gets its number of readings, whether all
    fields agree, and how many do not. Sums and amounts are written out here on wide
    decimals, so an error in the billing code is found and not repeated.
    """
    raw = readings.groupBy("sim_day", "household_id", "grid_zone").agg(
        F.round(F.sum(F.col("power_consumption_kwh").cast("decimal(20,10)")), 4).cast(amounts.KWH).alias("used"),
        F.round(F.sum(F.col("solar_generation_kwh").cast("decimal(20,10)")), 4).cast(amounts.KWH).alias("solar"),
        F.count(F.lit(1)).alias("readings"),
    )
    share = F.lit(Decimal(str(terms.subsidy_share)))
    owed = raw.join(tariff, ["sim_day", "household_id"], "left").withColumn(
        "net", F.when(F.col("used") > F.col("solar"), F.col("used") - F.col("solar")).otherwise(F.lit(Decimal("0.0000"))))
    owed = owed.withColumn("gross", F.round(F.col("net") * F.col("tariff_rate"), 2))
    owed = owed.withColumn("cut", F.when(F.col("subsidy_flag"), F.round(F.col("gross") * share, 2)).otherwise(F.lit(Decimal("0.00"))))
    fields = {"total_consumption_kwh": KWH_TOLERANCE, "total_solar_kwh": KWH_TOLERANCE,
              "net_kwh": KWH_TOLERANCE, "gross_amount": MONEY_TOLERANCE,
              "subsidy_amount": MONEY_TOLERANCE, "net_amount": MONEY_TOLERANCE}
    derived = [F.col("used"), F.col("solar"), F.col("net"), F.col("gross"), F.col("cut"), F.col("gross") - F.col("cut")]
    again = owed.select(
        "sim_day", "household_id", "grid_zone", "readings", F.col("billing_tier").alias("_tier"),
        *[value.cast(amounts.KWH).alias(f"_{f}") for f, value in zip(fields, derived, strict=True)]
    )
    both = stored.join(again, ["sim_day", "household_id", "grid_zone"], "left")
    pairs = [(f, F.col(f), F.col(f"_{f}"), tolerance) for f, tolerance in fields.items()]
    same_tier = F.coalesce(F.col("billing_tier") == F.col("_tier"), F.lit(False))
    wrong = F.size(_differences(pairs)) + F.when(same_tier, 0).otherwise(1)
    return both.select("sim_day", "household_id", F.coalesce("readings", F.lit(0)).alias("readings"),
                       wrong.alias("fields_wrong"), (wrong == 0).alias("agrees"))


def impossible_bills(bills: DataFrame) -> DataFrame:
    """Per day, bills that are negative or charge more units than were used."""
    bad = ((F.col("net_kwh") < 0) | (F.col("net_amount") < 0)
           | (F.col("net_kwh") > F.col("total_consumption_kwh")))
    return bills.groupBy("sim_day").agg(F.count(F.lit(1)).alias("bills"),
                                        F.count_if(bad).alias("impossible"))


def window_checks(windows: DataFrame, max_meters: Column, newest: int | None = None,
                  minutes: int = WINDOW_MINUTES, pct_tolerance: str = "0.02") -> DataFrame:
    """Length, share and meter count of all windows, or the newest: one line per check."""
    looked_at = windows if newest is None else windows.orderBy(
        F.col("window_start").desc(), "grid_zone").limit(newest)
    length = F.timestamp_diff("MICROSECOND", "window_start", "window_end") / F.lit(60_000_000.0)
    share = (F.col("total_solar_kwh").cast("double") * 100
             / F.nullif(F.col("total_consumption_kwh").cast("double"), F.lit(0.0)))
    checks = {
        "window_length": F.abs(length - F.lit(float(minutes))) > 1e-6,
        "renewable_pct": (F.col("total_consumption_kwh") > 0)
        & (F.abs(share - F.col("renewable_pct").cast("double")) > float(pct_tolerance)),
        "active_meters": F.col("active_meters") > max_meters,
    }
    counted = looked_at.agg(F.count(F.lit(1)).alias("n"),
                            *[F.count_if(c).alias(name) for name, c in checks.items()])
    lines = F.explode(F.array(*[
        F.struct(F.lit(name).alias("check"), F.col("n").alias("windows"),
                 F.col(name).alias("failed"), (F.col(name) == 0).alias("ok"))
        for name in checks
    ]))
    return counted.select(lines.alias("l")).select("l.*")


def zone_freshness(windows: DataFrame, zones: DataFrame, now: Column,
                   limit_seconds: int = NO_DATA_SECONDS + FRESHNESS_SLACK_SECONDS) -> DataFrame:
    """Every configured zone with its newest window, its age and a verdict."""
    newest = latest_per_group(windows, ["grid_zone"], [F.col("window_start").desc()])
    age = F.timestamp_diff("SECOND", F.col("updated_at"), now)
    fresh = F.coalesce(age <= limit_seconds, F.lit(False))
    joined = zones.select("grid_zone").join(newest, "grid_zone", "left")
    return joined.select("grid_zone", "window_start", "renewable_pct", "active_meters",
                         age.alias("age_seconds"), F.col("window_start").isNotNull().alias("reported"),
                         fresh.alias("ok"))


def layer_agreement(bills: DataFrame, windows: DataFrame) -> DataFrame:
    """Batch and stream totals per day and zone with their difference in percent.

    ``windows`` carry the local day in ``sim_day``. A zone-day without windows is said to
    have none rather than counted as zero.
    """
    batch = bills.groupBy("sim_day", "grid_zone").agg(
        F.sum("total_consumption_kwh").cast(amounts.KWH).alias("batch_kwh"))
    speed = windows.groupBy("sim_day", "grid_zone").agg(
        F.sum("total_consumption_kwh").cast(amounts.KWH).alias("speed_kwh"),
        F.count(F.lit(1)).alias("windows"))
    both = batch.join(speed, ["sim_day", "grid_zone"], "left")
    pct = amounts.difference_pct(F.col("batch_kwh"), F.col("speed_kwh"))
    verdict = F.when(F.col("speed_kwh").isNull(), "no windows").when(pct == 0, "equal") \
        .otherwise("differs")
    return both.select(
        "sim_day", "grid_zone", F.round("batch_kwh", 2).alias("batch_kwh"),
        F.round("speed_kwh", 2).alias("speed_kwh"),
        F.coalesce("windows", F.lit(0)).alias("windows"), pct.alias("difference_pct"),
        verdict.alias("verdict"),
    )


def latest_two_ways(windows: DataFrame, served: DataFrame, tolerance: str = "0.01") -> DataFrame:
    """Zones whose served latest share is not the one ``max_by`` finds; empty when right."""
    pct = F.when(F.col("window_start") < windows.agg(F.max("window_start")).scalar(),
                 F.col("renewable_pct"))
    start = F.when(pct.isNotNull(), F.col("window_start"))
    other = windows.groupBy("grid_zone").agg(F.max_by(pct, start).alias("_pct"))
    joined = served.join(other, "grid_zone", "full")
    differ = F.abs(F.col("renewable_pct") - F.col("_pct")) > F.lit(Decimal(tolerance))
    missing = F.col("renewable_pct").isNull() != F.col("_pct").isNull()
    return joined.where(F.coalesce(differ, F.lit(False)) | missing).select(
        "grid_zone", F.col("renewable_pct").alias("served_pct"), F.col("_pct").alias("derived_pct"))


def bill_ownership(stored: DataFrame, runs: DataFrame) -> DataFrame:
    """Per day: writers of its bills, and whether the one writer is the newest good run."""
    owners = stored.groupBy("sim_day").agg(
        F.count_distinct("run_id").alias("owners"), F.max("run_id").alias("owner"))
    newest = runs.groupBy("sim_day").agg(
        F.max_by(F.struct("run_id", "status"), F.struct("started_at", "run_id")).alias("r"))
    both = owners.join(newest, "sim_day", "left")
    one = F.col("owners") == 1
    traced = one & F.coalesce(F.col("owner") == F.col("r.run_id"), F.lit(False))
    good = traced & F.coalesce(F.col("r.status") == "SUCCESS", F.lit(False))
    return both.select("sim_day", "owners", F.col("r.run_id").alias("newest_run"),
                       F.col("r.status").alias("newest_status"), one.alias("one_owner"),
                       traced.alias("traced"), good.alias("ok"))


def reconcile(sources: DataFrame, stored: DataFrame, events_per_second: float,
              trigger_seconds: int = RAW_TRIGGER_SECONDS,
              triggers: int = LAG_BUDGET_TRIGGERS) -> DataFrame:
    """Source messages against distinct stored readings, per source.

    Verdicts: ``source_empty``; ``store_ahead`` (the source has expired what the store
    keeps, which is fine); ``within_budget`` or ``behind`` by the lag in rows.
    """
    budget = trigger_seconds * events_per_second * triggers
    both = sources.join(stored, "source", "left").withColumn(
        "stored", F.coalesce("stored", F.lit(0)))
    lag = F.col("messages") - F.col("stored")
    verdict = (F.when(F.col("messages") == 0, "source_empty").when(lag < 0, "store_ahead")
               .when(lag <= F.lit(budget), "within_budget").otherwise("behind"))
    return both.select(
        "source", "messages", "stored", lag.alias("lag"),
        amounts.share_pct(F.col("stored"), F.col("messages"), 1).alias("coverage_pct"),
        verdict.alias("verdict"),
        (~verdict.isin("source_empty", "behind")).alias("ok"),
    )


def offset_counts(offsets: DataFrame) -> DataFrame:
    """Messages held per source: end minus begin offset over its partitions."""
    return offsets.groupBy("source").agg(
        F.count(F.lit(1)).alias("partitions"),
        F.sum(F.col("end_offset") - F.col("begin_offset")).cast("bigint").alias("messages"))


def completeness(readings: DataFrame, configured: DataFrame, per_meter_day: int) -> DataFrame:
    """Rows of each zone-day against meters x readings per day."""
    stored = readings.groupBy("sim_day", "grid_zone").agg(F.count(F.lit(1)).alias("stored"))
    joined = stored.join(configured.select("grid_zone", "meters"), "grid_zone")
    expected = (F.col("meters") * per_meter_day).alias("expected")
    return joined.withColumn("expected", expected).withColumn(
        "completeness_pct", amounts.completeness_pct(F.col("stored"), F.col("expected")))


def day_crossings(readings: DataFrame, arrival_day: Column) -> DataFrame:
    """Readings that arrived on a later local day than they belong to; valid, but late."""
    late = arrival_day > F.col("sim_day")
    return readings.groupBy("sim_day").agg(F.count(F.lit(1)).alias("readings"),
                                           F.count_if(late).alias("arrived_next_day"))


def missing_columns(df: DataFrame, required: set[str]) -> list[str]:
    """Schema check: required columns the frame does not have."""
    return sorted(set(required) - set(df.columns))


# -- where two tables differ ---------------------------------------------------

def fingerprints(df: DataFrame, by: list[str], key: list[str], columns: list[str], parts: int = 256) -> DataFrame:
    """rows and mark, the sum of the rows' hashes, per group and range of the key's hash.

    Sums do not depend on order, and repeated rows count. A table's fingerprints can be
    kept and compared with those of any copy of it; coarser ones are sums of these.
    """
    part = F.pmod(F.xxhash64(*key), F.lit(parts)).cast("int").alias("part")
    mark = F.sum(F.xxhash64(*columns).cast("decimal(20,0)")).alias("mark")
    return df.groupBy(*by, part).agg(F.count(F.lit(1)).alias("rows"), mark)


def differing_ranges(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Groups and ranges whose fingerprints differ: by, part, rows on both sides.

    Groups are compared first, on the sums of their ranges; the ranges of equal ones never
    meet.
    """
    def whole(marks: DataFrame, side: str) -> DataFrame:
        return marks.groupBy(*by).agg(F.sum("rows").alias(f"{side}_rows"), F.sum("mark").alias(f"{side}_mark"))

    def differ(both: DataFrame) -> DataFrame:
        same = F.col("left_rows").eqNullSafe(F.col("right_rows")) & F.col("left_mark").eqNullSafe(F.col("right_mark"))
        return both.where(~same)

    groups = differ(whole(left, "left").join(whole(right, "right"), by, "full_outer")).select(*by)
    sides = [m.join(groups, by, "left_semi").select(*by, "part", F.col("rows").alias(f"{side}_rows"), F.col("mark").alias(f"{side}_mark"))
             for m, side in ((left, "left"), (right, "right"))]
    return differ(sides[0].join(sides[1], [*by, "part"], "full_outer")).select(
        *by, "part", *[F.coalesce(f"{side}_rows", F.lit(0)).alias(f"{side}_rows") for side in ("left", "right")])


def differing_rows(left: DataFrame, right: DataFrame, ranges: DataFrame, by: list[str], key: list[str], columns: list[str],
                   parts: int = 256) -> DataFrame:
    """Rows that one side has more often: by, the columns, and ``more`` (negative: the right side).

    Only rows of the given ranges are compared. Where ``by`` are partition columns of a
    stored side and ranges are few enough to be broadcast, other partitions' files are not
    opened: the condition on ranges, which always holds, lets Spark prune by them.
    """
    part = F.pmod(F.xxhash64(*key), F.lit(parts)).cast("int")
    ranges = ranges.where("left_rows + right_rows > 0")
    chosen = [df.withColumn("part", part).join(ranges.select(*by, "part"), [*by, "part"], "left_semi").select(*by, *columns, F.lit(n).alias("n"))
              for df, n in ((left, 1), (right, -1))]
    counted = chosen[0].unionByName(chosen[1]).groupBy(*by, *columns).agg(F.sum("n").alias("more"))
    return counted.where("more <> 0")
