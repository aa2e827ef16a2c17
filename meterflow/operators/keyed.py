"""Tables with a key on plain Parquet: merges and newest-version views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterflow.operators.ordering import latest_per_group


def newest_version(versions: DataFrame, key: list[str], version: str) -> DataFrame:
    """The row with the highest version per key."""
    return latest_per_group(versions, key, [F.col(version).desc()])


def merge_keyed(existing: DataFrame, incoming: DataFrame, key: list[str]) -> DataFrame:
    """Existing rows with incoming rows put over them on the key; incoming wins.

    A union and a rank rather than a full outer join: both sides are reduced to one row
    per key before the shuffle and no column needs a coalesce.
    """
    both = existing.withColumn("_side", F.lit(0)).unionByName(incoming.withColumn("_side", F.lit(1)))
    return newest_version(both, key, "_side").drop("_side")


def replace_days(existing: DataFrame, incoming: DataFrame, day: str = "sim_day") -> DataFrame:
    """Whole days replaced by the incoming ones, which also drops rows a re-run no longer
    produces. The query form of a dynamic partition overwrite. The days, of which a
    thousand years have some 365,000, are broadcast: the table doesn't meet on its days."""
    days = incoming.select(day).distinct()
    return existing.join(F.broadcast(days), day, "left_anti").unionByName(incoming)


def constraint_findings(df: DataFrame, key: list[str], required: list[str],
                        domains: dict[str, list] | None = None) -> DataFrame:
    """Key, not-null and domain violations as rows (check, column, violations).

    Null and domain counts share one aggregate; the key check is one more.
    """
    checks: list[tuple[str, str, Column]] = [
        ("not_null", name, F.count_if(F.col(name).isNull())) for name in required
    ]
    for name, values in (domains or {}).items():
        checks.append(("domain", name, F.count_if(~F.coalesce(F.col(name).isin(*values), F.lit(True)))))
    counted = df.agg(*[agg.alias(f"{kind}:{name}") for kind, name, agg in checks])
    rows = F.explode(F.array(*[
        F.struct(F.lit(kind).alias("check"), F.lit(name).alias("column"),
                 F.col(f"`{kind}:{name}`").alias("violations"))
        for kind, name, _ in checks
    ]))
    per_column = counted.select(rows.alias("r")).select("r.*")
    repeated = (
        df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        .agg(F.count(F.lit(1)).alias("violations"))
        .select(F.lit("primary_key").alias("check"), F.lit(", ".join(key)).alias("column"),
                "violations")
    )
    return per_column.unionByName(repeated)
