"""The shared star-schema tables mapped to the metering model.

events     one reading each: purchases are generation, everything else is consumption
customer   the household and meter, its region the grid zone
lineitem   usage of the customer who ordered, shipped quantity as energy
orders     runs of the components named by the order priority
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from meterflow.functions import times
from meterflow.functions.amounts import sum_kwh
from meterflow.operators import ledger
from meterflow.operators.sampling import rate_table
from meterflow.settings import AlertThresholds, TIMEZONE
from meterflow.sources import records

# The stand-in's energy is far above a household's, so its overload limit is too.
THRESHOLDS = AlertThresholds(overload_kw_per_meter=40.0)
RESEND_DELAY_MINUTES = 15


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customer_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """user_id, grid_zone. Nation and region are left to Catalyst's broadcast threshold."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    zones = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return customer.join(zones, customer.c_nationkey == zones.n_nationkey).select(
        F.col("c_custkey").alias("user_id"), F.col("r_name").alias("grid_zone"))


def _zoned(spark: SparkSession, sf_dir: str, facts: DataFrame) -> DataFrame:
    """Facts with their customer's zone: one pass over the facts. Whether the dimension is
    broadcast, and how a customer with very many facts is split, is adaptive execution's."""
    return facts.join(customer_zones(spark, sf_dir), "user_id")


def readings(spark: SparkSession, sf_dir: str, timezone: str = TIMEZONE,
             resent: bool = False) -> DataFrame:
    """Readings with arrival up to 20 minutes late.

    With ``resent`` every error event is delivered a second time, 15 minutes later: the
    store of an at-least-once pipeline. One scan serves both copies.
    """
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    rows = _zoned(spark, sf_dir, events)
    generated = F.col("event_type") == "purchase"
    delay = ((F.col("event_id") * 7919) % 21).cast("int")
    if resent:
        again = F.array(F.lit(0), F.lit(RESEND_DELAY_MINUTES))
        rows = rows.withColumn("_resent", F.explode(
            F.when(F.col("event_type") == "error", again).otherwise(F.array(F.lit(0)))))
        delay = delay + F.col("_resent")
    return rows.select(
        F.col("event_id").alias("position"),
        F.concat(F.lit("M-"), F.col("user_id")).alias("meter_id"),
        F.concat(F.lit("H-"), F.col("user_id")).alias("household_id"),
        "grid_zone",
        F.when(generated, 0.0).otherwise(F.col("value")).alias("power_consumption_kwh"),
        F.when(generated, F.col("value")).otherwise(0.0).alias("solar_generation_kwh"),
        F.col("ts").alias("timestamp"),
        times.local_day("ts", timezone).alias("sim_day"),
        (F.col("ts") + F.make_dt_interval(mins=delay)).alias("ingested_at"),
        "event_type",
    )


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON records as a topic would hold them; error events arrive damaged in six ways."""
    good = readings(spark, sf_dir)
    text = records.to_records(good)
    kind = F.when(F.col("event_type") == "error", F.col("position") % 6).otherwise(-1)
    damaged = (
        F.when(kind == 0, F.concat(F.lit("oops "), F.col("meter_id")))
        .when(kind == 1, F.regexp_replace(text, r'("power_consumption_kwh":)[^,]+', '$1"abc"'))
        .when(kind == 2, F.regexp_replace(text, r'"grid_zone":"[^"]*",', ""))
        .when(kind == 3, F.regexp_replace(text, r'("power_consumption_kwh":)', "$1-"))
        .when(kind == 4, F.regexp_replace(text, r'("timestamp":)"[^"]*"', '$1"bad"'))
        .when(kind == 5, F.regexp_replace(text, r'("solar_generation_kwh":)[^,]+', "$1null"))
        .otherwise(text)
    )
    return good.select("position", "ingested_at", damaged.cast("binary").alias("value"))


def households(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    return customers.select(F.concat(F.lit("H-"), F.col("c_custkey")).alias("household_id"),
                            F.col("c_mktsegment").alias("segment"))


def tariff(spark: SparkSession, sf_dir: str, timezone: str = TIMEZONE,
           priced_segments_only: bool = False) -> DataFrame:
    """Rates of every household for every day of the readings.

    Catalyst cannot see how many days a household is spread over and would take the
    result for small, so the join that uses it is asked to sort and merge.
    """
    who = households(spark, sf_dir)
    if priced_segments_only:
        who = who.where("segment <> 'MACHINERY'")
    events = table(spark, sf_dir, "events")
    bounds = events.agg(F.min("ts").alias("first"), F.max("ts").alias("last")).select(F.struct(
        times.local_day("first", timezone).alias("first"), times.local_day("last", timezone).alias("last"))).scalar()
    return rate_table(who, bounds["first"], bounds["last"]).hint("merge")


def zone_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configured zones and their meters: every customer of the region."""
    return customer_zones(spark, sf_dir).groupBy("grid_zone").agg(
        F.count(F.lit(1)).alias("meters"))


def configured_households(spark: SparkSession, sf_dir: str) -> Column:
    return table(spark, sf_dir, "customer").agg(F.count(F.lit(1))).scalar()


def stamped(bills: DataFrame) -> DataFrame:
    """Bills with writer and write time: zone ASIA of an odd day was billed once more."""
    odd = F.dayofmonth("sim_day") % 2 == 1
    run = F.when((F.col("grid_zone") == "ASIA") & odd, 2).otherwise(1)
    written = F.date_add("sim_day", 1).cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(5) + run)
    return bills.select("*", _run_id(run).alias("run_id"), written.alias("generated_at"))


def _run_id(number: Column) -> Column:
    return F.concat(F.lit("billing-"), F.date_format("sim_day", "yyyyMMdd"), F.lit("-"),
                    number.cast("string"))


def billing_runs(spark: SparkSession, sf_dir: str, timezone: str = TIMEZONE) -> DataFrame:
    """The runs behind ``stamped``: one a day, two on odd days; each tenth day failed."""
    days = table(spark, sf_dir, "events").select(
        times.local_day("ts", timezone).alias("sim_day")).distinct()
    numbers = F.when(F.dayofmonth("sim_day") % 2 == 1, F.array(F.lit(1), F.lit(2))) \
        .otherwise(F.array(F.lit(1)))
    dated = days.withColumn("_n", F.explode(numbers))
    return dated.select(
        _run_id(F.col("_n")).alias("run_id"), F.lit("billing_batch").alias("component"),
        F.when(F.dayofmonth("sim_day") % 10 == 0, "FAILED").otherwise("SUCCESS").alias("status"),
        "sim_day",
        (F.date_add("sim_day", 1).cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(5) + F.col("_n")))
        .alias("started_at"),
    )


def lineitem_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usage per customer, region and ship day from line items, summed before any lookup.

    Quantity is consumption, quantity x discount generation. Lines are reduced to one row
    per customer and day before the zone is looked up.
    """
    line = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), "l_quantity", "l_discount", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("orderkey"),
                                                   F.col("o_custkey").alias("user_id"))
    ordered = line.join(orders, "orderkey")
    per_customer = ordered.groupBy(F.to_date("l_shipdate").alias("sim_day"), "user_id").agg(
        sum_kwh("l_quantity").alias("used"), sum_kwh(F.col("l_quantity") * F.col("l_discount")).alias("solar"))
    rows = _zoned(spark, sf_dir, per_customer)
    return rows.select(
        "sim_day", F.concat(F.lit("H-"), F.col("user_id")).alias("household_id"), "grid_zone",
        F.col("used").alias("total_consumption_kwh"), F.col("solar").alias("total_solar_kwh"),
        F.lit(1).cast("bigint").alias("active_meters"),
    )


def run_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger events from orders: F succeeded, O failed, P never closed its run."""
    orders = table(spark, sf_dir, "orders")
    start = F.col("o_orderdate") + F.make_dt_interval(secs=((F.col("o_orderkey") * 7919) % 86400))
    took = (F.col("o_totalprice") / 60).cast("bigint")
    runs = orders.select(
        F.concat(F.lit("run-"), F.col("o_orderkey")).alias("run_id"),
        F.col("o_orderpriority").alias("component"), F.to_date("o_orderdate").alias("sim_day"),
        start.alias("started_at"), (start + F.make_dt_interval(secs=took)).alias("ended_at"),
        F.when(F.col("o_orderstatus") == "F", "SUCCESS")
        .when(F.col("o_orderstatus") == "O", "FAILED").alias("status"),
        (F.col("o_orderkey") % 500).alias("rows_written"),
        F.when(F.col("o_totalprice") > 250000, F.concat(F.lit("order "), F.col("o_orderkey")))
        .alias("notes"),
    )
    starts = ledger.start_event(runs.withColumn("at", F.col("started_at")))
    ends = ledger.finish_event(runs.where("status is not null").withColumn("at", F.col("ended_at")))
    return starts.unionByName(ends)


def topic_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Begin and end offset per topic partition: each zone a source, event types partitions."""
    return readings(spark, sf_dir).groupBy(F.col("grid_zone").alias("source"), "event_type").agg(
        F.min("position").alias("begin_offset"),
        (F.min("position") + F.count(F.lit(1))).alias("end_offset"))


def counter_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A counter of each zone's events, read at the last event of ten minutes: it begins
    again with each day, as a process that is restarted does."""
    per_line = readings(spark, sf_dir).groupBy(
        "grid_zone", F.to_date("timestamp").alias("day"), F.window("timestamp", "10 minutes").alias("w")).agg(
            F.max("timestamp").alias("at"), F.count(F.lit(1)).alias("n"))
    so_far = Window.partitionBy("grid_zone", "day").orderBy("w").rowsBetween(Window.unboundedPreceding, 0)
    return per_line.select("grid_zone", "at", F.sum("n").over(so_far).alias("events_total"))
