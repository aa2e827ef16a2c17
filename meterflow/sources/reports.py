"""The bill report as CSV and its check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterflow.operators import ordering

# Column order of the report.
COLUMNS = [
    "sim_day", "household_id", "grid_zone",
    "total_consumption_kwh", "total_solar_kwh", "net_kwh",
    "billing_tier", "tariff_rate", "subsidy_flag",
    "gross_amount", "subsidy_amount", "net_amount",
]
#: The folder that a report's rows of a day lie in.
FOLDER = "report_day"


def write_report(bills: DataFrame, path: str) -> None:
    """One folder per day, rows in total order by household; a re-run replaces its own days only.

    Rows are dealt out by ranges of (day, household) whose ends are sampled, so a day of
    ordinary size is one file and a large one several, which follow one another in the
    order of their names. ``bills`` is read twice, for the sample and for the rows, and
    should be a table.
    """
    rows = bills.select(*COLUMNS).repartitionByRange("sim_day", "household_id").withColumn(FOLDER, F.col("sim_day"))
    (rows.sortWithinPartitions(FOLDER, "household_id")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(FOLDER).option("header", True).csv(path))


def read_report(spark: SparkSession, path: str) -> DataFrame:
    kinds = {"subsidy_flag": "boolean", "household_id": "string", "grid_zone": "string",
             "billing_tier": "string", "sim_day": "date"}
    schema = ", ".join(f"{c} {kinds.get(c, 'decimal(18,4)')}" for c in COLUMNS)
    return spark.read.schema(f"{schema}, {FOLDER} date").option("header", True).csv(path).drop(FOLDER)


def report_order(spark: SparkSession, path: str) -> DataFrame:
    """Per day: rows of the report, and whether reading its files in the order of their names
    gives them by household."""
    rows = (spark.read.schema(f"{', '.join(f'{c} string' for c in COLUMNS)}, {FOLDER} date").option("header", True).csv(path)
            .select(F.col(FOLDER).alias("sim_day"), "household_id", F.col("_metadata.file_name").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")))
    checked = ordering.out_of_order(rows, "sim_day", ["file", "block", "line"], "household_id", F.col("file"))
    return checked.select("sim_day", F.col("events").alias("rows"), (F.col("out_of_order") == 0).alias("in_order"))


def check_report(report: DataFrame, bills: DataFrame) -> DataFrame:
    """Rows of the report against rows of the bill table, per day."""
    written = report.groupBy("sim_day").agg(F.count(F.lit(1)).alias("report_rows"))
    stored = bills.groupBy("sim_day").agg(F.count(F.lit(1)).alias("bill_rows"))
    both = stored.join(written, "sim_day", "left").withColumn(
        "report_rows", F.coalesce("report_rows", F.lit(0)))
    return both.withColumn("ok", F.col("report_rows") == F.col("bill_rows"))
