"""The query catalogue: name -> function of (spark, folder of the given tables)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from meterflow import settings
from meterflow.functions import hashing, times
from meterflow.operators import (alerts, audit, billing, counters, dedupe, energy, joins, keyed,
                                 ledger, ordering, sampling)
from meterflow.plans import billing_run, reports, streams
from meterflow.sources import bucketed, records, reports as report_files, standin, store, tariff_files
from meterflow.workspace import materialised, shared_folder

TZ = settings.TIMEZONE
KNOWN_ZONE = "ASIA"


class Model:
    """The model's tables derived from one folder, each built once as a plan."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def readings(self):
        return standin.readings(self.spark, self.sf_dir)

    def stored(self):
        return standin.readings(self.spark, self.sf_dir, resent=True)

    def unique(self):
        return dedupe.dedupe_readings(self.stored())

    def usage(self):
        return energy.daily_usage(self.unique())

    def tariff(self, **options):
        return standin.tariff(self.spark, self.sf_dir, **options)

    def bills(self):
        return billing.bills_from_usage(self.usage(), self.tariff())

    def stamped_bills(self):
        return standin.stamped(self.bills())

    def windows(self):
        return energy.zone_windows(self.readings(), TZ)

    def alerts(self):
        return self.alerts_of(self.windows())

    def runs(self):
        return ledger.fold(self.run_events())

    def run_events(self):
        return standin.run_events(self.spark, self.sf_dir)

    def zones(self):
        return standin.zone_dimension(self.spark, self.sf_dir)

    def households(self):
        return standin.configured_households(self.spark, self.sf_dir)

    def stored_windows(self):
        """Zone windows as a table, for reports that read them more than once."""
        return materialised(self.windows(), "windows")

    @staticmethod
    def now(windows):
        """The report time: the newest arrival, so that reports can be repeated."""
        return windows.agg(F.max("updated_at")).scalar()

    @staticmethod
    def alerts_of(windows):
        raised = alerts.evaluate(windows, TZ, standin.THRESHOLDS)
        return raised.withColumn("run_id", F.lit("speed-1"))

    def table(self, name):
        return standin.table(self.spark, self.sf_dir, name)


def portable(df: DataFrame) -> DataFrame:
    """Result columns as every client shows them alike: DECIMAL as DOUBLE, days as ISO text."""
    columns = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            col = col.cast("double")
        elif isinstance(field.dataType, T.DateType):
            col = col.cast("string")
        columns.append(col.alias(field.name))
    return df.select(*columns)


_CATALOGUE: dict = {}


def query(build):
    """Registers a builder of (Model) under its own name."""
    _CATALOGUE[build.__name__] = lambda spark, sf_dir: portable(build(Model(spark, sf_dir)))
    return build


def catalogue() -> dict:
    return dict(_CATALOGUE)


# -- records and readings ----------------------------------------------------

@query
def parse_readings(m):
    parsed = records.parse_readings(standin.raw_records(m.spark, m.sf_dir), TZ, "ingested_at")
    return parsed.select(*records.READING_COLUMNS)


@query
def quarantine_reasons(m):
    refused = records.quarantine(standin.raw_records(m.spark, m.sf_dir))
    return refused.groupBy("reason").agg(F.count(F.lit(1)).alias("records"))


@query
def dedupe_readings(m):
    return m.unique().select("meter_id", "timestamp", "ingested_at", "sim_day", "grid_zone",
                             "power_consumption_kwh", "solar_generation_kwh")


@query
def duplicate_stats(m):
    readings = m.readings()
    again = readings.where("event_type = 'error'").withColumn(
        "ingested_at", F.col("ingested_at") + F.make_dt_interval(mins=F.lit(15)))
    return dedupe.duplicate_stats(dedupe.with_replay(readings, again))


@query
def daily_usage(m):
    return m.usage()


@query
def zone_day_totals(m):
    return energy.zone_day_totals(m.unique())


@query
def partition_counts(m):
    return energy.partition_counts(m.unique())


@query
def sample_summary(m):
    return energy.stream_sample_summary(m.readings())


@query
def closed_days(m):
    return energy.closed_days(m.readings(), TZ, settings.WATERMARK_MINUTES)


@query
def newest_day_readings(m):
    """The default day, the newest stored one, found and read in one plan."""
    readings = m.readings()
    newest = m.table("events").agg(F.max("ts").alias("ts")).select(times.local_day("ts", TZ)).scalar()
    return readings.where(F.col("sim_day") == newest).select(
        "meter_id", "timestamp", "sim_day", "grid_zone", "power_consumption_kwh")


@query
def day_text_forms(m):
    """Days written in five ways; only digits with or without dashes are accepted."""
    forms = {"click": "yyyyMMdd", "view": "yyyy-MM-dd", "signup": "yyyy/MM/dd",
             "purchase": "yyyy-MMdd"}
    text = F.concat(F.lit("day "), F.date_format("ts", "yyyyMMdd"))
    for kind, pattern in forms.items():
        text = F.when(F.col("event_type") == kind, F.date_format("ts", pattern)).otherwise(text)
    parsed = m.table("events").select("event_type", times.parse_day(text).alias("day"))
    return parsed.groupBy("event_type", "day").agg(F.count(F.lit(1)).alias("texts"))


# -- windows -----------------------------------------------------------------

_WINDOW = ["window_start", "window_end", "grid_zone", "total_consumption_kwh", "total_solar_kwh",
           "renewable_pct", "active_meters"]


@query
def zone_windows(m):
    return energy.zone_windows(m.readings(), "UTC").select(*_WINDOW)


@query
def zone_windows_colombo(m):
    return m.windows().select(*_WINDOW, "updated_at", "readings")


@query
def renewable_share(m):
    """Share per household and day, also above 100 and 0 without consumption."""
    shares = energy.with_renewable_pct(m.usage())
    return shares.select("sim_day", "household_id", "grid_zone", "renewable_pct")


@query
def local_time_text(m):
    return m.table("events").select(
        "event_id", times.local_text("ts", TZ).alias("wall_clock"),
        times.offset_text("ts", TZ).alias("with_offset"),
        times.hour_in(times.to_local("ts", TZ), 6, 18).alias("is_daytime"))


@query
def window_alignment(m):
    """Colombo-clock windows through window() and its start shift, as a stream cuts them."""
    shift = f"{times.window_shift_minutes(TZ, 60)} minutes"
    hour = F.window("ts", "60 minutes", "60 minutes", shift).alias("w")
    counted = m.table("events").groupBy(hour).agg(F.count(F.lit(1)).alias("events"))
    return counted.select(F.col("w.start").alias("window_start"), "events")


@query
def approx_meters(m):
    """Whether the sketched meter count of each day and zone is within 15 % of the exact."""
    counted = m.unique().groupBy("sim_day", "grid_zone").agg(
        F.count_distinct("meter_id").alias("exact"),
        F.approx_count_distinct("meter_id", 0.05).alias("approx"))
    within = F.abs(F.col("approx") - F.col("exact")) <= F.col("exact") * 0.15
    return counted.select("sim_day", "grid_zone", within.alias("within_15_pct"))


@query
def meters_from_sketches(m):
    """Days' totals of zones, and of the grid from these, out of windows with sketches alone;
    meters are compared with their exact numbers."""
    windows = materialised(energy.zone_windows(m.readings(), TZ, meters="sketch"), "sketches")
    zones = energy.rolled_up(windows.withColumn("sim_day", times.local_day("window_start", TZ)), ["sim_day", "grid_zone"])
    grid = energy.rolled_up(zones, ["sim_day"]).withColumn("grid_zone", F.lit("all"))
    exact = m.readings().select("sim_day", "meter_id", F.explode(F.array("grid_zone", F.lit("all"))).alias("grid_zone")).groupBy(
        "sim_day", "grid_zone").agg(F.count_distinct("meter_id").alias("exact"))
    within = F.abs(F.col("active_meters") - F.col("exact")) <= F.col("exact") * 0.05
    return zones.unionByName(grid).join(exact, ["sim_day", "grid_zone"], "full_outer").select(
        "sim_day", "grid_zone", "total_consumption_kwh", "total_solar_kwh", "renewable_pct", within.alias("within_5_pct"))


# -- alerts ------------------------------------------------------------------

@query
def threshold_alerts(m):
    return m.alerts()


@query
def alert_counts(m):
    return alerts.counts(m.alerts())


@query
def latest_message_by_rule(m):
    return alerts.latest_message(m.alerts())


@query
def recent_alerts(m):
    return alerts.recent(m.alerts(), 50, grid_zone=KNOWN_ZONE)


@query
def alerts_in_range(m):
    day = F.lit("2024-01-10").cast("timestamp_ntz")
    return alerts.in_range(m.alerts(), day, day + F.make_dt_interval(days=F.lit(7)))


@query
def firing_count(m):
    """Conditions that fire: alert rules, and households without a rate."""
    rules = m.alerts().select(F.col("rule").alias("condition"))
    unpriced = billing.unpriced(m.usage(), m.tariff(priced_segments_only=True))
    return reports.firing_count(rules.unionByName(unpriced.select(F.lit("unpriced").alias("condition"))))


# -- rates and sampling ------------------------------------------------------

@query
def tariff_table(m):
    return m.tariff()


@query
def weighted_tier(m):
    terms = sampling.household_terms(standin.households(m.spark, m.sf_dir))
    return terms.groupBy("billing_tier", "subsidy_flag").agg(F.count(F.lit(1)).alias("households"))


@query
def quota_sample(m):
    """Panels by quota: each market segment gets its share of its customers."""
    shares = {"AUTOMOBILE": 0.75, "BUILDING": 0.60, "FURNITURE": 0.45, "HOUSEHOLD": 0.30}
    share = F.lit(0.5)
    for name, value in shares.items():
        share = F.when(F.col("segment") == name, value).otherwise(share)
    people = standin.households(m.spark, m.sf_dir).withColumn("share", share)
    return sampling.quota_sample(people, "segment", "household_id", "share")


@query
def stable_fraction(m):
    who = standin.households(m.spark, m.sf_dir)
    return who.select("household_id", *[
        hashing.stable_fraction(salt, F.col("household_id")).alias(f"{salt}_fraction")
        for salt in ("solar", "tier", "subsidy")])


@query
def undefined_tiers(m):
    """Segments that customers have and priced segments do not."""
    present = standin.households(m.spark, m.sf_dir).select("segment")
    priced = standin.households(m.spark, m.sf_dir).where("segment <> 'MACHINERY'")
    return joins.set_difference(present, priced.select("segment"), ["segment"])


# -- bills -------------------------------------------------------------------

@query
def daily_bills(m):
    return m.bills()


@query
def bill_summary(m):
    return billing.summarise(m.bills())


@query
def day_bills(m):
    return billing.day_totals(m.bills(), m.households()).withColumn(
        "currency", F.lit(settings.CURRENCY))


@query
def bills_of_day(m):
    """All bills of one day, ordered by household."""
    chosen = m.stamped_bills().where(F.col("sim_day") == F.lit("2024-01-15").cast("date"))
    return chosen.orderBy("household_id")


@query
def unpriced_households(m):
    return billing.unpriced(m.usage(), m.tariff(priced_segments_only=True)).select(
        "sim_day", "household_id", "grid_zone", "total_consumption_kwh")


@query
def repeated_tariffs(m):
    """Rates with the priced segments delivered twice: every one of them is reported."""
    twice = m.tariff().unionByName(m.tariff(priced_segments_only=True))
    return billing.repeated_tariffs(twice)


@query
def multi_metered(m):
    """Customers of a nation share a meter board: days with other than one meter."""
    customer = m.table("customer").select(
        F.concat(F.lit("M-"), F.col("c_custkey")).alias("meter_id"),
        F.concat(F.lit("N-"), F.col("c_nationkey")).alias("board"))
    boards = m.unique().join(customer, "meter_id").drop("household_id")
    usage = energy.daily_usage(boards.withColumnRenamed("board", "household_id"))
    return billing.multi_metered(usage)


@query
def two_zone_households(m):
    """Market segments taken as households: each spans several zones on a day."""
    customer = m.table("customer").select(
        F.concat(F.lit("H-"), F.col("c_custkey")).alias("household_id"), "c_mktsegment")
    usage = m.usage().join(customer, "household_id").drop("household_id")
    merged = usage.groupBy("sim_day", F.col("c_mktsegment").alias("household_id"), "grid_zone").agg(
        F.sum("total_consumption_kwh").alias("total_consumption_kwh"))
    return billing.two_zone_households(merged)


@query
def partial_days(m):
    return billing.partial_days(m.bills(), m.households())


@query
def lineitem_bills(m):
    """Bills of the line-item usage, each at the rate of its own day and household."""
    usage = standin.lineitem_usage(m.spark, m.sf_dir)
    return billing.bills_from_usage(usage, sampling.rates_of(usage))


@query
def lineitem_bill_summary(m):
    usage = standin.lineitem_usage(m.spark, m.sf_dir)
    return billing.summarise(billing.bills_from_usage(usage, sampling.rates_of(usage)))


# -- serving -----------------------------------------------------------------

@query
def latest_complete_window(m):
    return reports.zones(m.windows())


@query
def latest_any_window(m):
    return reports.zones(m.windows(), include_open=True)


@query
def latest_by_time(m):
    latest = ordering.latest_windows(m.windows())
    return latest.select(F.col("window_start").alias("time"), "grid_zone", "renewable_pct",
                         "total_consumption_kwh").orderBy("time", "grid_zone")


@query
def latest_sum(m):
    return reports.latest_sum(m.windows())


@query
def grid_totals(m):
    return reports.zones_total(m.windows())


@query
def zone_history(m):
    return reports.zone_history(m.windows(), KNOWN_ZONE, 24)


@query
def zone_series(m):
    start = F.lit("2024-01-05").cast("timestamp_ntz")
    return reports.zone_series(m.windows(), start, start + F.make_dt_interval(days=F.lit(14)))


@query
def zone_status(m):
    """Zones and, as names nobody configured, nations."""
    regions = m.table("region").select(F.col("r_name").alias("grid_zone"))
    nations = m.table("nation").select(F.col("n_name").alias("grid_zone"))
    return reports.zone_status(m.windows(), m.zones(), regions.unionByName(nations))


@query
def simulated_clock(m):
    return reports.simulated_clock(m.windows(), TZ)


@query
def billed_days(m):
    return billing.billed_days(m.stamped_bills(), 14)


@query
def day_list(m):
    return m.bills().select("sim_day").distinct().orderBy(F.col("sim_day").desc())


@query
def zone_revenue(m):
    return billing.zone_revenue(m.bills())


@query
def day_tile(m):
    return billing.day_tile(m.bills())


@query
def top_bills(m):
    return billing.top_bills(m.bills(), 10)


@query
def bottom_bills(m):
    return billing.bottom_bills(m.bills(), 10)


@query
def recent_days(m):
    return billing.recent_days(m.bills(), 14)


@query
def coverage_by_zone(m):
    return billing.zone_coverage(m.bills())


@query
def pick_subsidised(m):
    return billing.pick_for_check(m.bills())


@query
def health_row(m):
    windows = m.stored_windows()
    return reports.health(windows, m.zones(), m.now(windows))


@query
def metric_rows(m):
    windows, runs = m.stored_windows(), materialised(m.runs(), "runs")
    return reports.metric_rows(windows, m.alerts_of(windows), runs, m.now(windows), "1-URGENT")


@query
def status_bands(m):
    windows = m.stored_windows()
    return reports.status_bands(windows, m.alerts_of(windows), m.now(windows))


@query
def table_counts(m):
    windows = m.stored_windows()
    return reports.table_counts(windows=windows, alerts=m.alerts_of(windows),
                                runs=m.run_events().where("kind = 'start'"), bills=m.bills())


# -- order, rates, gaps ------------------------------------------------------

@query
def out_of_order_events(m):
    return ordering.out_of_order(m.readings(), "grid_zone", ["ingested_at", "position"], "timestamp",
                                 F.date_trunc("hour", "ingested_at"))


@query
def order_check(m):
    """A listing of windows per zone, one zone's oldest first: which are newest first.

    The listing gives places; the times at neighbouring places are compared.
    """
    age = -F.unix_seconds(F.col("window_start").cast("timestamp"))
    listed = m.windows().select("grid_zone", age.alias("age"), F.when(F.col("grid_zone") == KNOWN_ZONE, -age).otherwise(age).alias("place"))
    checked = ordering.out_of_order(listed, "grid_zone", ["place"], "age", F.floor(F.col("place") / 86400))
    return checked.select("grid_zone", F.col("events").alias("windows"),
                          (F.col("out_of_order") == 0).alias("newest_first"))


@query
def throughput_per_minute(m):
    return reports.throughput(m.readings())


@query
def errors_recent(m):
    """Refused records of the last five minutes, per reason and minute."""
    refused = records.quarantine(standin.raw_records(m.spark, m.sf_dir), keep=["ingested_at"])
    return ordering.trailing_counts(refused, "ingested_at", ["reason"], 5)


@query
def no_data_gaps(m):
    return ordering.gaps(m.readings(), "ingested_at", 20 * 60)


@query
def no_data_gaps_by_zone(m):
    return ordering.gaps(m.readings(), "ingested_at", 2 * 3600, ["grid_zone"])


@query
def counter_increase(m):
    """How much each zone's event counter rose in the hour before every half hour."""
    return counters.over_ranges(standin.counter_samples(m.spark, m.sf_dir), ["grid_zone"], "at", "events_total", 3600, 1800)


@query
def gauge_delta(m):
    """The same samples taken as a gauge, which may fall, over four hours."""
    return counters.over_ranges(standin.counter_samples(m.spark, m.sf_dir), ["grid_zone"], "at", "events_total", 14400, 3600,
                                counter=False).select("grid_zone", "at", "samples", "increase")


@query
def late_day_crossings(m):
    return audit.day_crossings(m.readings(), times.local_day("ingested_at", TZ))


# -- runs --------------------------------------------------------------------

@query
def run_ledger(m):
    return m.runs()


@query
def run_counts(m):
    return ledger.counts(m.runs())


@query
def recent_runs(m):
    return ledger.recent(m.runs(), 15)


@query
def newest_run_per_day(m):
    return ledger.newest_per_day(m.runs(), "1-URGENT")


@query
def failed_runs_recent(m):
    """Failures in the two days before the newest event of the ledger."""
    now = m.run_events().agg(F.max("at")).scalar()
    return ledger.failed_in_last(m.runs(), 2 * 24 * 60, now)


@query
def last_success_duration(m):
    return ledger.last_success_seconds(m.runs())


@query
def bill_ownership(m):
    stored = m.stamped_bills()
    return audit.bill_ownership(stored, standin.billing_runs(m.spark, m.sf_dir))


# -- audits ------------------------------------------------------------------

@query
def missing_zones(m):
    """Configured zones (nations here) that never reported under that name."""
    configured = m.table("nation").select(F.col("n_name").alias("grid_zone"))
    return joins.set_difference(configured, m.windows(), ["grid_zone"])


@query
def unexpected_zones(m):
    """Reported zones that are not among the configured ones (one region left out)."""
    configured = m.table("region").where("r_name <> 'EUROPE'").select(
        F.col("r_name").alias("grid_zone"))
    return joins.set_difference(m.windows(), configured, ["grid_zone"])


@query
def offset_counts(m):
    return audit.offset_counts(standin.topic_offsets(m.spark, m.sf_dir))


@query
def reconcile_counts(m):
    """Messages per zone against distinct parsed readings; damaged records are the lag."""
    sources = audit.offset_counts(standin.topic_offsets(m.spark, m.sf_dir))
    parsed = records.parse_readings(standin.raw_records(m.spark, m.sf_dir), TZ, "ingested_at")
    keys = parsed.groupBy("grid_zone", "meter_id", "timestamp").agg(F.count(F.lit(1)).alias("n"))
    stored = keys.groupBy(F.col("grid_zone").alias("source")).agg(F.count(F.lit(1)).alias("stored"))
    return audit.reconcile(sources, stored, events_per_second=8.0)


@query
def completeness(m):
    return audit.completeness(m.unique(), m.zones(), settings.READINGS_PER_METER_DAY)


@query
def expected_rows(m):
    expected = (F.col("meters") * settings.READINGS_PER_METER_DAY).alias("expected_rows")
    return m.zones().select("grid_zone", "meters", expected)


@query
def constraint_findings(m):
    """Keys, nulls and domains of the run ledger's events, which repeat each run id."""
    return keyed.constraint_findings(
        m.run_events(), ["run_id"], ["run_id", "component", "at", "status"],
        {"status": ["RUNNING", "SUCCESS"], "kind": ["start", "finish"]})


def _tampered(bills: DataFrame) -> DataFrame:
    """Stored bills of subsidised top-tier households changed by five cents."""
    changed = (F.col("billing_tier") == "domestic-3") & F.col("subsidy_flag")
    more = (F.col("net_amount") + F.when(changed, F.lit(0.05).cast("decimal(3,2)")).otherwise(
        F.lit(0).cast("decimal(3,2)"))).cast("decimal(18,2)")
    return bills.withColumn("net_amount", more)


@query
def verify_bills(m):
    return audit.verify_bills(_tampered(m.bills()))


@query
def recompute_bills(m):
    return audit.recompute_bills(_tampered(m.bills()), m.unique(), m.tariff())


@query
def impossible_bills(m):
    """Bills of which one zone's charge more than was used and subsidised ones are negative."""
    more = F.when(F.col("grid_zone") == KNOWN_ZONE, F.lit(1)).otherwise(F.lit(0)).cast("decimal(18,4)")
    less = F.when(F.col("subsidy_flag"), -F.col("net_amount") - 1).otherwise(F.col("net_amount")).cast("decimal(18,2)")
    damaged = m.bills().withColumns({"net_kwh": (F.col("total_consumption_kwh") * more + F.col("net_kwh") + more).cast("decimal(18,4)"), "net_amount": less})
    return audit.impossible_bills(damaged)


@query
def window_checks(m):
    """Windows of which one zone's are a minute too long: only the length fails."""
    longer = F.when(F.col("grid_zone") == KNOWN_ZONE, 1).otherwise(0)
    damaged = m.windows().withColumn("window_end", F.col("window_end") + F.make_dt_interval(mins=longer))
    return audit.window_checks(damaged, m.households())


@query
def window_checks_all(m):
    """Windows with one zone's share off by one point and another's meters counted too high."""
    off = F.when(F.col("grid_zone") == KNOWN_ZONE, F.lit(1)).otherwise(F.lit(0))
    many = F.when(F.col("grid_zone") == "EUROPE", F.lit(1_000_000)).otherwise(F.lit(0))
    damaged = m.windows().withColumns({
        "renewable_pct": F.col("renewable_pct") + off, "active_meters": F.col("active_meters") + many})
    return audit.window_checks(damaged, m.households())


@query
def zone_freshness(m):
    asked = m.table("region").select(F.col("r_name").alias("grid_zone")).unionByName(
        m.table("nation").select(F.col("n_name").alias("grid_zone")))
    windows = m.stored_windows()
    return audit.zone_freshness(windows, asked, m.now(windows), limit_seconds=1200)


@query
def layer_agreement(m):
    """Batch bills against windows built without the dedupe: replays show as a difference."""
    live = energy.zone_windows(m.stored(), TZ)
    dated = live.withColumn("sim_day", times.local_day("window_start", TZ))
    return audit.layer_agreement(m.bills(), dated)


@query
def latest_two_ways(m):
    """Served shares of which one is off by a point and one is missing."""
    windows = m.stored_windows()
    served = reports.zones(windows).where("grid_zone <> 'EUROPE'").select(
        "grid_zone", (F.col("renewable_pct") + F.when(F.col("grid_zone") == KNOWN_ZONE, 1).otherwise(0)).alias("renewable_pct"))
    return audit.latest_two_ways(windows, served)


# -- keyed tables ------------------------------------------------------------

@query
def merge_keyed(m):
    """Zone windows kept live, replays included, then merged with the exact ones."""
    live = energy.zone_windows(m.stored(), TZ).select(*_WINDOW).withColumn("source", F.lit("live"))
    late = energy.zone_windows(m.stored().where("event_type = 'error'"), TZ).select(*_WINDOW)
    return keyed.merge_keyed(live, late.withColumn("source", F.lit("late")),
                             ["window_start", "grid_zone"])


@query
def upsert_bills(m):
    """A re-run of the odd days with the priced segments only replaces those days whole."""
    usage = materialised(m.usage(), "usage")
    first = billing.bills_from_usage(usage, m.tariff()).withColumn("run", F.lit(1))
    odd = F.dayofmonth("sim_day") % 2 == 1
    rates = m.tariff(priced_segments_only=True)
    again = billing.bill(usage.where(odd).join(rates, billing.BILL_KEY)).select(*billing.BILL_COLUMNS)
    merged = keyed.replace_days(first, again.withColumn("run", F.lit(2)))
    return merged.select("sim_day", "household_id", "grid_zone", "net_amount",
                         F.col("run").cast("bigint").alias("run"))


# -- files -------------------------------------------------------------------

@query
def csv_tariff_typed(m):
    """Rates written as CSV files, one folder per day, and read back typed."""
    path = shared_folder(m.spark, "tariff")
    tariff_files.write_tariff(m.tariff(), path)
    return tariff_files.read_tariff(m.spark, path)


@query
def report_roundtrip(m):
    """The bill report written per day, read back and counted against the bills."""
    path, bills = shared_folder(m.spark, "report"), materialised(m.bills(), "bills")
    report_files.write_report(bills, path)
    return report_files.check_report(report_files.read_report(m.spark, path), bills)


@query
def report_in_order(m):
    """The bill report read file by file: rows per day and whether they are in order."""
    path = shared_folder(m.spark, "report")
    report_files.write_report(materialised(m.bills(), "bills"), path)
    return report_files.report_order(m.spark, path)


@query
def usage_from_buckets(m):
    """Daily usage from a store in buckets of the household, replays included."""
    path, table = shared_folder(m.spark, "bucketed"), f"readings_{uuid.uuid4().hex}"
    bucketed.write_bucketed(m.stored(), table, f"{path}/readings", buckets=32)
    return bucketed.daily_usage(m.spark, table)


@query
def layer_difference_rows(m):
    """The readings that a store with replays holds more often than one without, found by
    fingerprints: groups, then ranges, then the rows of differing ranges."""
    columns = ["meter_id", "timestamp", "power_consumption_kwh", "solar_generation_kwh", "ingested_at"]
    by, key, stores = ["sim_day", "grid_zone"], ["meter_id", "timestamp"], []
    for name, rows in (("replayed", m.stored()), ("unique", m.unique())):
        path = shared_folder(m.spark, name)
        store.append_readings(rows.select(*records.READING_COLUMNS), path)
        stores.append(store.read_readings(m.spark, path, dedupe=False))
    marks = [materialised(audit.fingerprints(s, by, key, columns), "fingerprints") for s in stores]
    ranges = materialised(audit.differing_ranges(*marks, by), "ranges")
    return audit.differing_rows(*stores, ranges, by, key, columns)


@query
def store_layout(m):
    """The store written by day and zone: partitions found in paths, rows read back."""
    path = shared_folder(m.spark, "store")
    columns = records.READING_COLUMNS
    store.append_readings(m.stored().select(*columns), path)
    files = store.layout_check(m.spark, path).groupBy("sim_day", "grid_zone").agg(
        F.bool_and("fits").alias("fits"))
    rows = m.spark.read.parquet(path).groupBy(
        F.date_format("sim_day", "yyyy-MM-dd").alias("sim_day"), "grid_zone").agg(
            F.count(F.lit(1)).alias("rows"))
    return rows.join(files, ["sim_day", "grid_zone"])


@query
def store_summary(m):
    """Rows and distinct readings of the written store."""
    path = shared_folder(m.spark, "store")
    store.append_readings(m.stored().select(*records.READING_COLUMNS), path)
    return store.store_summary(m.spark, path).drop("files")


@query
def stored_day(m):
    """One day read from the store written by day and zone, duplicates removed."""
    path = shared_folder(m.spark, "store")
    store.append_readings(m.stored().select(*records.READING_COLUMNS), path)
    return store.read_readings(m.spark, path, "2024-01-15").select(
        "meter_id", "timestamp", "sim_day", "grid_zone", "power_consumption_kwh", "solar_generation_kwh")


@query
def rates_of_day(m):
    """The rates of one day, found by its folder among all days' files."""
    path = shared_folder(m.spark, "tariff")
    tariff_files.write_tariff(m.tariff(), path)
    return tariff_files.read_day(m.spark, path, dt.date(2024, 1, 15))


@query
def windows_of_day(m):
    """Windows that start on a local day, found on the stored UTC column."""
    return energy.windows_of_day(m.windows(), "2024-01-15", TZ).select(*_WINDOW)


@query
def run_findings(m):
    """All households that stop a billing run or give a warning, with priced segments only."""
    found = billing_run.findings(m.usage(), m.tariff(priced_segments_only=True))
    return found.groupBy("level", "finding", "sim_day").agg(F.count(F.lit(1)).alias("households"))


@query
def billing_run_day(m):
    """The newest closed day billed from the stored readings and the day's rate file, twice:
    the second run's bills take the place of the first one's."""
    path = shared_folder(m.spark, "billing-run")
    store.append_readings(m.stored().select(*records.READING_COLUMNS), f"{path}/store")
    tariff_files.write_tariff(m.tariff(), f"{path}/tariff")
    for run_id in ("billing-1", "billing-2"):
        billing_run.run(m.spark, *[f"{path}/{place}" for place in ("store", "tariff", "bills", "report", "ledger")], run_id)
    runs = billing_run.read_ledger(m.spark, f"{path}/ledger").select("run_id", "status", "rows_written")
    bills = billing_run.read_bills(m.spark, f"{path}/bills").select("sim_day", "household_id", "grid_zone", "net_amount", "run_id")
    return bills.join(runs, "run_id")


# -- streams -----------------------------------------------------------------

@query
def stream_raw_store(m):
    return streams.raw_store(m.spark, m.sf_dir)


@query
def stream_new_checkpoint(m):
    return streams.new_checkpoint(m.spark, m.sf_dir)


@query
def stream_zone_windows(m):
    return streams.zone_windows(m.spark, m.sf_dir)


@query
def stream_final_windows(m):
    return streams.final_windows(m.spark, m.sf_dir)


@query
def stream_dedup_windows(m):
    return streams.dedup_windows(m.spark, m.sf_dir)


@query
def stream_alerts(m):
    return streams.alert_log(m.spark, m.sf_dir)


@query
def live_table_compacted(m):
    return streams.compacted_windows(m.spark, m.sf_dir)


@query
def stream_alerts_early(m):
    return streams.early_alerts(m.spark, m.sf_dir)


@query
def stream_no_data(m):
    return streams.no_data(m.spark, m.sf_dir)


@query
def checkpoint_fit(m):
    return streams.checkpoint_fit(m.spark, m.sf_dir)


@query
def stream_late_rows(m):
    return streams.late_rows(m.spark, m.sf_dir)
