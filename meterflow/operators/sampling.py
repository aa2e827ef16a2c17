"""Deterministic sampling and the rate table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from meterflow.functions import hashing
from meterflow.settings import (RATE_JITTER, SUBSIDY_PROBABILITY, TIER_RATES, TIER_WEIGHTS,
                                check_tiers)

#: Tasks at least that households are dealt out to before each gets a row a day.
SPREAD = 128


def quota_sample(df: DataFrame, group: str, member: str, share: str, salt: str = "solar",
                 bucket_bits: int = 12) -> DataFrame:
    """Marks exactly ``round(n * share)`` members of each group, lowest hashes first.

    ``share`` names a column that is constant in the group. Ranking a whole group in one
    task would not scale, so members are counted per hash bucket: buckets below the quota
    are taken whole and only the bucket the quota falls in is ranked, which is about
    n / 2^bucket_bits members. The quota rounds half to even.
    """
    people = df.groupBy(group, member).agg(F.max(share).alias("_share"))
    hashed = people.withColumn("_bits", hashing.stable_bits(salt, F.col(member))).withColumn(
        "_bucket", F.shiftright("_bits", 32 - bucket_bits)
    )
    sizes = hashed.groupBy(group, "_bucket").agg(
        F.count(F.lit(1)).alias("_size"), F.max("_share").alias("_share")
    )
    whole_group = Window.partitionBy(group)
    rising = whole_group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    marks = sizes.select(
        group, "_bucket",
        (F.sum("_size").over(rising) - F.col("_size")).alias("_before"),
        F.sum("_size").over(rising).alias("_through"),
        F.rint(F.sum("_size").over(whole_group) * F.col("_share")).cast("bigint").alias("quota"),
    )
    placed = hashed.drop("_share").join(marks, [group, "_bucket"])
    deciding = (F.col("_before") < F.col("quota")) & (F.col("_through") > F.col("quota"))
    sure = placed.where(~deciding).select(group, member, "quota", (F.col("_through") <= F.col("quota")).alias("chosen"))
    in_bucket = Window.partitionBy(group, "_bucket").orderBy("_bits", member)
    ranked = placed.where(deciding).withColumn("_place", F.col("_before") + F.row_number().over(in_bucket))
    return sure.unionByName(ranked.select(group, member, "quota", (F.col("_place") <= F.col("quota")).alias("chosen")))


def household_terms(households: DataFrame, rates: dict = TIER_RATES, weights: dict = TIER_WEIGHTS,
                    subsidy_probability: float = SUBSIDY_PROBABILITY, keep: list[str] | None = None) -> DataFrame:
    """Tier and subsidy flag of each household, the parts that do not change by day."""
    check_tiers(rates, weights)
    who = F.col("household_id")
    return households.select(
        "household_id", *(keep or []),
        hashing.weighted_choice(hashing.stable_fraction("tier", who), weights)
        .alias("billing_tier"),
        hashing.flag_with_probability(hashing.stable_fraction("subsidy", who),
                                      subsidy_probability).alias("subsidy_flag"),
    )


def daily_rate(household, day, tier, rates: dict = TIER_RATES, jitter: float = RATE_JITTER):
    base = F.lit(None).cast("double")
    for name, rate in sorted(rates.items()):
        base = F.when(tier == name, F.lit(float(rate))).otherwise(base)
    drawn = hashing.stable_fraction("rate", household, F.date_format(day, "yyyy-MM-dd"))
    return hashing.jittered(base, drawn, jitter)


def rate_table(households: DataFrame, first_day, last_day, rates: dict = TIER_RATES,
               weights: dict = TIER_WEIGHTS, subsidy_probability: float = SUBSIDY_PROBABILITY,
               jitter: float = RATE_JITTER) -> DataFrame:
    """One row per household and day between two days (Columns or literals).

    A file of households is small however many rows they become, so one task would read and
    multiply them all. They are dealt out first, to a number that adaptive execution keeps:
    it knows the households' size only.
    """
    tasks = max(SPREAD, int(households.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = households.repartition(tasks, "household_id")
    terms = household_terms(dealt, rates, weights, subsidy_probability)
    dated = terms.withColumn(
        "sim_day", F.explode(F.sequence(first_day.cast("date"), last_day.cast("date")))
    )
    return _rates(dated, rates, jitter)


def rates_of(usage: DataFrame) -> DataFrame:
    """The rates of just the days and households that have usage."""
    pairs = usage.select("sim_day", "household_id").distinct()
    return _rates(household_terms(pairs.select("household_id", "sim_day"), keep=["sim_day"]), TIER_RATES, RATE_JITTER)


def _rates(dated: DataFrame, rates: dict, jitter: float) -> DataFrame:
    return dated.select(
        "sim_day", "household_id",
        daily_rate(F.col("household_id"), F.col("sim_day"), F.col("billing_tier"), rates, jitter)
        .cast("decimal(9,2)").alias("tariff_rate"),
        "billing_tier", "subsidy_flag",
    )
