"""Rate files: one CSV per day, every field present, typed by expressions."""

from __future__ import annotations

import re
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from meterflow.functions import amounts, times
from meterflow.sources.store import list_files

# The file's contract.
FIELDS = ["household_id", "tariff_rate", "billing_tier", "subsidy_flag"]
NAME_PATTERN = "tariff_{sim_day}.csv"


def file_name(day: date, pattern: str = NAME_PATTERN) -> str:
    return pattern.format(sim_day=day.strftime("%Y%m%d"))


def read_text_rows(spark: SparkSession, path: str, pattern: str = NAME_PATTERN,
                   glob: str = "*.csv") -> DataFrame:
    """Rows of one file or of all files in a folder as text, with the day of the file."""
    schema = ", ".join(f"{name} string" for name in FIELDS)
    rows = (spark.read.schema(schema).option("header", True).option("enforceSchema", False)
            .option("recursiveFileLookup", "true").option("pathGlobFilter", glob).csv(path))
    shape = re.escape(pattern).replace(re.escape("{sim_day}"), "([0-9]{8})")
    stamp = F.regexp_extract(F.col("_metadata.file_path"), shape, 1)
    folder = F.regexp_extract(F.col("_metadata.file_path"), "sim_day=([0-9-]{10})/", 1)
    return rows.withColumn(
        "sim_day", times.parse_day(F.coalesce(F.nullif(stamp, F.lit("")), folder))
    )


def faults(rows: DataFrame) -> DataFrame:
    """Rows with an empty field or a rate that is no number, with the field named."""
    found = [F.when(F.coalesce(F.trim(F.col(name)), F.lit("")) == "",
                    F.concat(F.lit("missing "), F.lit(name))) for name in FIELDS]
    found.append(F.when(F.col("tariff_rate").isNotNull()
                        & F.expr("try_cast(tariff_rate as decimal(9,2))").isNull(),
                        F.lit("tariff_rate is not a number")))
    return rows.withColumn("fault", F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())))


def typed(rows: DataFrame) -> DataFrame:
    """Typed rates; the flag is true only for the word true."""
    return rows.select(
        "sim_day", "household_id",
        F.expr("try_cast(tariff_rate as decimal(9,2))").alias("tariff_rate"),
        "billing_tier", amounts.strict_bool(F.col("subsidy_flag")).alias("subsidy_flag"),
    )


def _checked(rows: DataFrame, what: str) -> DataFrame:
    bad = faults(rows).groupBy("fault").agg(
        F.count(F.lit(1)).alias("n"), F.min("household_id").alias("first")).orderBy("fault").collect()
    if bad:
        raise ValueError("rate rows are faulty (faults() lists them): "
                         + "; ".join(f"{r.fault}: {r.first} and {r.n - 1} more" for r in bad))
    if rows.isEmpty():
        raise ValueError(f"{what} is missing or holds a header but no rows")
    return typed(rows)


def read_tariff(spark: SparkSession, path: str, pattern: str = NAME_PATTERN) -> DataFrame:
    """Typed rates of a file or folder; a faulty row or a file without rows is an error."""
    return _checked(read_text_rows(spark, path, pattern), path)


def read_day(spark: SparkSession, path: str, day: date, pattern: str = NAME_PATTERN) -> DataFrame:
    """Typed rates of one day, without touching other days' files.

    ``path`` is a single CSV file, taken as that day's; a folder with one file per day
    named by the pattern; or a folder ``write_tariff`` has written.
    """
    if path.endswith(".csv"):
        return read_tariff(spark, path, pattern).withColumn("sim_day", F.lit(day))
    try:
        return read_tariff(spark, f"{path}/sim_day={day.isoformat()}", pattern)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    return _checked(read_text_rows(spark, path, pattern, glob=file_name(day, pattern)),
                    f"{path}/{file_name(day, pattern)}")


def write_tariff(tariff: DataFrame, path: str) -> None:
    """One folder per day with header and the flag as the words true and false."""
    text = tariff.select("sim_day", "household_id", F.col("tariff_rate").cast("string"),
                         "billing_tier", F.col("subsidy_flag").cast("string"))
    (text.hint("rebalance", "sim_day").write.mode("overwrite").partitionBy("sim_day")
     .option("header", True).csv(path))


def available(spark: SparkSession, path: str) -> DataFrame:
    """Rate files below a folder, without reading them."""
    return list_files(spark, path, "*.csv").orderBy("path")
