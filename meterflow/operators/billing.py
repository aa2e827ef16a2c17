"""Usage and rates to bills. All days of a frame are billed in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterflow.functions import amounts
from meterflow.operators.ordering import latest_per_group, newest_then_ascending, top
from meterflow.settings import BillingTerms

BILL_KEY = ["sim_day", "household_id"]
BILL_COLUMNS = [
    "sim_day", "household_id", "grid_zone", "total_consumption_kwh", "total_solar_kwh",
    "net_kwh", "tariff_rate", "billing_tier", "subsidy_flag", "gross_amount",
    "subsidy_amount", "net_amount",
]


def join_tariff(usage: DataFrame, tariff: DataFrame, on: list[str] | None = None) -> DataFrame:
    """Left join, so a household without a rate stays and can be named.

    No broadcast hint: rates grow with households and days, so the choice is left to
    Catalyst and adaptive execution, which know the sizes. Usage has one row per
    household, zone and day, so no join key can be hot.
    """
    return usage.join(tariff, on or BILL_KEY, "left")


def unpriced(usage: DataFrame, tariff: DataFrame, on: list[str] | None = None) -> DataFrame:
    """Usage rows without a rate; a run must not write while there are any."""
    return usage.join(tariff, on or BILL_KEY, "left_anti")


def repeated_tariffs(tariff: DataFrame, on: list[str] | None = None) -> DataFrame:
    """Keys with more than one rate row: the join would bill them twice."""
    counts = tariff.groupBy(*(on or BILL_KEY)).agg(F.count(F.lit(1)).alias("rate_rows"))
    return counts.where("rate_rows > 1")


def bill(priced: DataFrame, terms: BillingTerms = BillingTerms()) -> DataFrame:
    """Net units, gross, subsidy and payable amount for rows that have a rate."""
    col = F.col
    return (
        priced
        .withColumn("net_kwh", amounts.net_kwh(col("total_consumption_kwh"),
                                               col("total_solar_kwh")))
        .withColumn("tariff_rate", col("tariff_rate").cast(amounts.RATE))
        .withColumn("gross_amount", amounts.gross_amount(col("net_kwh"), col("tariff_rate")))
        .withColumn("subsidy_amount", amounts.subsidy_amount(
            col("gross_amount"), col("subsidy_flag"), terms.subsidy_share))
        .withColumn("net_amount",
                    (col("gross_amount") - col("subsidy_amount")).cast(amounts.MONEY))
    )


def bills_from_usage(usage: DataFrame, tariff: DataFrame, terms: BillingTerms = BillingTerms(),
                     on: list[str] | None = None) -> DataFrame:
    return bill(join_tariff(usage, tariff, on), terms).select(*BILL_COLUMNS)


def multi_metered(usage: DataFrame) -> DataFrame:
    """Households metered by other than one meter on a day: a warning, not an error."""
    return usage.where("active_meters <> 1").select(*BILL_KEY, "grid_zone", "active_meters")


def two_zone_households(usage: DataFrame) -> DataFrame:
    """Households with usage in several zones on one day: their bills share a key."""
    counts = usage.groupBy(*BILL_KEY).agg(F.count(F.lit(1)).alias("zones"))
    return counts.where("zones > 1")


def partial_days(bills: DataFrame, configured_households: Column) -> DataFrame:
    counted = bills.groupBy("sim_day").agg(F.count(F.lit(1)).alias("billed"))
    with_goal = counted.withColumn("configured", configured_households)
    return with_goal.where("billed <> configured")


def _money(name: str, alias: str | None = None) -> Column:
    return F.sum(name).cast(amounts.MONEY).alias(alias or name)


def _kwh(name: str, places: int, alias: str | None = None) -> Column:
    kind = f"decimal(18,{places})"
    return F.round(F.sum(name), places).cast(kind).alias(alias or name)


def summarise(bills: DataFrame) -> DataFrame:
    """Day totals: households, energy, amounts, subsidised households."""
    return bills.groupBy("sim_day").agg(
        F.count(F.lit(1)).alias("households"),
        _kwh("total_consumption_kwh", 4), _kwh("total_solar_kwh", 4), _kwh("net_kwh", 4),
        _money("gross_amount"), _money("subsidy_amount"), _money("net_amount"),
        F.count_if(F.col("subsidy_flag")).alias("subsidised_households"),
    )


def day_totals(bills: DataFrame, configured_households: Column) -> DataFrame:
    """Header of a day's bill list: billed and configured households and amounts."""
    return bills.groupBy("sim_day").agg(
        F.count(F.lit(1)).alias("households"),
        _kwh("net_kwh", 4, "total_net_kwh"), _money("gross_amount", "total_gross_amount"),
        _money("subsidy_amount", "total_subsidy_amount"), _money("net_amount", "total_net_amount"),
    ).withColumn("households_configured", configured_households)


def billed_days(stored: DataFrame, limit: int = 14) -> DataFrame:
    """Newest billed days; ``runs`` above 1 means a day is split between two runs."""
    return stored.groupBy("sim_day").agg(
        F.count(F.lit(1)).alias("households"),
        _kwh("net_kwh", 3), _money("net_amount"),
        F.count_distinct("run_id").alias("runs"),
        F.max("generated_at").alias("generated_at"),
    ).orderBy(F.col("sim_day").desc()).limit(limit)


def zone_coverage(bills: DataFrame) -> DataFrame:
    """Per day and zone: bills, energy, payable amount, subsidised households."""
    return bills.groupBy("sim_day", "grid_zone").agg(
        F.count(F.lit(1)).alias("households"),
        _kwh("total_consumption_kwh", 3, "consumption_kwh"), _kwh("total_solar_kwh", 3, "solar_kwh"),
        _kwh("net_kwh", 3), _money("net_amount"),
        F.count_if(F.col("subsidy_flag")).alias("subsidised"),
    )


def zone_revenue(bills: DataFrame) -> DataFrame:
    """Per day and zone: households, energy, solar share (null without use), revenue."""
    used, solar = F.sum("total_consumption_kwh"), F.sum("total_solar_kwh")
    return bills.groupBy("sim_day", "grid_zone").agg(
        F.count(F.lit(1)).alias("households"),
        _kwh("total_consumption_kwh", 2, "consumption_kwh"), _kwh("total_solar_kwh", 2, "solar_kwh"),
        amounts.share_pct(solar, used, 1, empty=None).alias("solar_share_pct"),
        _money("net_amount", "revenue"),
    )


def day_tile(bills: DataFrame) -> DataFrame:
    """The six figures of a day: households, used, solar, billed, subsidy, revenue."""
    return bills.groupBy("sim_day").agg(
        F.count(F.lit(1)).alias("households_billed"),
        _kwh("total_consumption_kwh", 1, "consumption_kwh"), _kwh("total_solar_kwh", 1, "solar_kwh"),
        _kwh("net_kwh", 1, "net_billed_kwh"), _money("subsidy_amount", "subsidy"),
        _money("net_amount", "revenue"),
    )


def recent_days(bills: DataFrame, n: int = 14) -> DataFrame:
    per_day = bills.groupBy("sim_day").agg(_money("net_amount", "revenue"),
                                           _money("subsidy_amount", "subsidy"))
    return newest_then_ascending(per_day, "sim_day", n)


def top_bills(bills: DataFrame, n: int = 10) -> DataFrame:
    """Each day's highest bills; equal amounts are ordered by household."""
    order = [F.col("net_amount").desc(), F.col("household_id")]
    return latest_per_group(bills.select("sim_day", "household_id", "net_amount"), ["sim_day"], order, n)


def bottom_bills(bills: DataFrame, n: int = 10) -> DataFrame:
    """Each day's lowest bills with the part of use that solar covered."""
    lowest = latest_per_group(bills, ["sim_day"], [F.col("net_amount"), F.col("household_id")], n)
    return lowest.select(
        "sim_day", "household_id", "grid_zone",
        F.round("total_consumption_kwh", 2).alias("used_kwh"),
        F.round("total_solar_kwh", 2).alias("solar_kwh"),
        amounts.share_pct(F.col("total_solar_kwh"), F.col("total_consumption_kwh"), 1, empty=None)
        .alias("solar_offset_pct"),
        "subsidy_flag", "subsidy_amount", "net_amount",
    )


def pick_for_check(bills: DataFrame, household: str | None = None) -> DataFrame:
    """Per day the household to recheck by hand: subsidised ones with solar come first."""
    chosen = bills if household is None else bills.where(F.col("household_id") == household)
    telling = F.col("subsidy_flag") & (F.col("total_solar_kwh") > 0)
    return latest_per_group(chosen, ["sim_day"], [telling.desc(), F.col("household_id")])
