from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from meterflow.operators import audit, billing, energy, sampling
from meterflow.settings import BillingTerms
from tests.helpers import readings, rows

DAY = date(2026, 1, 21)
USAGE = ("sim_day date, household_id string, grid_zone string, total_consumption_kwh decimal(18,4), "
         "total_solar_kwh decimal(18,4), active_meters bigint")
RATES = ("sim_day date, household_id string, tariff_rate decimal(9,2), billing_tier string, "
         "subsidy_flag boolean")


def usage(spark, *people):
    return spark.createDataFrame(
        [(DAY, h, "Kandy", Decimal(c), Decimal(s), 1) for h, c, s in people], USAGE)


def rates(spark, *people):
    return spark.createDataFrame([(DAY, h, Decimal(r), "domestic-2", f) for h, r, f in people], RATES)


@pytest.mark.parametrize("used, solar, rate, flag, net, gross, subsidy, pay", [
    ("18", "6", "45", True, "12", "540", "54", "486"),
    ("18", "6", "45", False, "12", "540", "0", "540"),
    ("8", "20", "45", True, "0", "0", "0", "0"),
    ("21.6811", "7.0044", "46.25", True, "14.6767", "678.80", "67.88", "610.92"),
    ("21.4214", "6.8579", "30.85", False, "14.5635", "449.28", "0", "449.28"),
])
def test_worked_bills(spark, used, solar, rate, flag, net, gross, subsidy, pay):
    b = billing.bills_from_usage(usage(spark, ("H-1", used, solar)), rates(spark, ("H-1", rate, flag))).first()
    got = (b.net_kwh, b.gross_amount, b.subsidy_amount, b.net_amount, b.total_solar_kwh)
    assert got == tuple(Decimal(x) for x in (net, gross, subsidy, pay, solar))


def test_the_parts_of_a_bill_add_up(spark):
    people = [("H-1", "17.3333", "5.1111", "41.37"), ("H-2", "23.9999", "0", "62.53"),
              ("H-3", "9.1234", "9.1233", "30.21")]
    bills = billing.bills_from_usage(usage(spark, *[p[:3] for p in people]),
                                     rates(spark, *[(p[0], p[3], True) for p in people]))
    assert bills.where("gross_amount - subsidy_amount <> net_amount").count() == 0


def test_day_summary(spark):
    bills = billing.bills_from_usage(usage(spark, ("H-1", "18", "6"), ("H-2", "20", "0")),
                                     rates(spark, ("H-1", "45", True), ("H-2", "30", False)))
    s = billing.summarise(bills).first()
    assert (s.households, s.net_kwh, s.gross_amount, s.net_amount, s.subsidised_households) == (
        2, Decimal(32), Decimal(1140), Decimal(1086), 1)
    tile = billing.day_tile(bills).first()
    assert (tile.households_billed, tile.revenue) == (2, Decimal(1086))
    assert billing.partial_days(bills, F.lit(3).cast("bigint")).count() == 1
    assert billing.partial_days(bills, F.lit(2).cast("bigint")).count() == 0


def test_rate_faults_are_findings(spark):
    used = usage(spark, ("H-1", "1", "0"), ("H-2", "1", "0"))
    some = rates(spark, ("H-1", "45", True), ("H-1", "46", True))
    assert rows(billing.unpriced(used, some).select("household_id")) == [("H-2",)]
    assert rows(billing.repeated_tariffs(some).select("household_id", "rate_rows")) == [("H-1", 2)]


def test_household_in_two_zones_and_with_two_meters(spark):
    df = readings(spark, [(1, "a", 1, 0, "2026-01-01T01:00"), (1, "b", 1, 0, "2026-01-01T02:00"),
                          (2, "a", 1, 0, "2026-01-01T01:00")])
    used = energy.daily_usage(df)
    assert rows(billing.two_zone_households(used).select("household_id")) == [("H-1",)]
    shared = df.withColumn("household_id", F.lit("H-9")).where("grid_zone = 'a'")
    assert rows(billing.multi_metered(energy.daily_usage(shared)).select("household_id", "active_meters")) \
        == [("H-9", 2)]


def test_equal_bills_are_ordered_by_household(spark):
    people = [(f"H-{i}", "10", "0") for i in range(9, 0, -1)]
    bills = billing.bills_from_usage(usage(spark, *people), rates(spark, *[(p[0], "45", False) for p in people]))
    assert [r.household_id for r in billing.top_bills(bills, 3).collect()] == ["H-1", "H-2", "H-3"]
    assert [r.household_id for r in billing.bottom_bills(bills, 2).collect()] == ["H-1", "H-2"]


def test_pick_for_check_prefers_subsidised_solar(spark):
    bills = billing.bills_from_usage(
        usage(spark, ("H-1", "10", "0"), ("H-2", "10", "1"), ("H-3", "10", "1")),
        rates(spark, ("H-1", "45", True), ("H-2", "45", False), ("H-3", "45", True)))
    assert billing.pick_for_check(bills).first().household_id == "H-3"
    assert billing.pick_for_check(bills, "H-1").first().household_id == "H-1"


def test_other_schemes_are_refused():
    with pytest.raises(ValueError):
        BillingTerms(net_metering="export_paid")


# -- checks on stored bills --------------------------------------------------

def test_wrong_amounts_are_found_field_by_field(spark):
    bills = billing.bills_from_usage(usage(spark, ("H-1", "18", "6"), ("H-2", "20", "0")),
                                     rates(spark, ("H-1", "45", True), ("H-2", "30", False)))
    assert audit.verify_bills(bills).count() == 0
    off = bills.withColumn("net_amount", F.when(F.col("household_id") == "H-1", F.col("net_amount") + Decimal("0.02"))
                           .otherwise(F.col("net_amount") + Decimal("0.01")).cast("decimal(18,2)"))
    assert rows(audit.verify_bills(off).select("household_id", "field", "stored", "derived")) == [
        ("H-1", "net_amount", Decimal("486.02"), Decimal("486.00"))]


def test_recompute_from_readings(spark):
    raw = readings(spark, [(1, "Kandy", 10, 3, "2026-01-21T01:00"), (1, "Kandy", 8, 3, "2026-01-21T02:00"),
                           (2, "Kandy", 5, 0, "2026-01-21T02:00")])
    tariff = rates(spark, ("H-1", "45", True), ("H-2", "30", False))
    bills = billing.bills_from_usage(energy.daily_usage(raw), tariff)
    assert rows(audit.recompute_bills(bills, raw, tariff).select("household_id", "readings", "agrees"), "household_id") \
        == [("H-1", 2, True), ("H-2", 1, True)]
    less = raw.where("timestamp < timestamp_ntz'2026-01-21 02:00'")
    assert rows(audit.recompute_bills(bills, less, tariff).select("household_id", "agrees"), "household_id") \
        == [("H-1", False), ("H-2", False)]


def test_impossible_bills(spark):
    bills = billing.bills_from_usage(usage(spark, ("H-1", "18", "6")), rates(spark, ("H-1", "45", True)))
    broken = bills.withColumn("net_kwh", F.lit(99).cast("decimal(18,4)"))
    assert rows(audit.impossible_bills(bills.unionByName(broken)).select("bills", "impossible")) == [(2, 1)]


def test_rates_of_one_file_of_households_are_made_and_counted_in_many_tasks(spark):
    who = spark.range(2000).coalesce(1).select(F.concat(F.lit("H-"), F.col("id")).alias("household_id"))
    table = sampling.rate_table(who, F.lit("2026-01-01"), F.lit("2026-01-10"))
    per_task = [r["count"] for r in table.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert sum(per_task) == 20_000 and max(per_task) < 1000
    twice = billing.repeated_tariffs(table.unionByName(table.where("household_id <> 'H-7'")))
    assert twice.count() == 19_990 and twice.where("rate_rows <> 2").isEmpty()
