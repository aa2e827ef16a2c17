"""Small frames for the tests."""

from datetime import datetime

from pyspark.sql import functions as F

READING = ("meter_id string, household_id string, grid_zone string, power_consumption_kwh double, "
           "solar_generation_kwh double, timestamp timestamp_ntz, ingested_at timestamp_ntz")


def at(text):
    return datetime.fromisoformat(text)


def readings(spark, rows, timezone="UTC"):
    """(meter, zone, used, solar, time[, arrival]) rows as readings."""
    from meterflow.functions import times

    full = [(f"M-{r[0]}", f"H-{r[0]}", r[1], float(r[2]), float(r[3]), at(r[4]),
             at(r[5] if len(r) > 5 else r[4])) for r in rows]
    frame = spark.createDataFrame(full, READING)
    return frame.withColumn("sim_day", times.local_day("timestamp", timezone))


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def literal(spark, *columns):
    """Evaluates columns on one row."""
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def dec(text, kind="decimal(18,4)"):
    return F.lit(text).cast(kind)
