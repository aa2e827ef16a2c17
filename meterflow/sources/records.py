"""Raw records to typed readings, and the reasons why a record is refused."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from meterflow.functions import times

# Declared, never inferred: a stream has no data to infer from.
RECORD_SCHEMA = T.StructType([
    T.StructField("meter_id", T.StringType()),
    T.StructField("household_id", T.StringType()),
    T.StructField("grid_zone", T.StringType()),
    T.StructField("power_consumption_kwh", T.DoubleType()),
    T.StructField("solar_generation_kwh", T.DoubleType()),
    T.StructField("timestamp", T.TimestampType()),
])
FIELDS = RECORD_SCHEMA.fieldNames()
NUMBERS = ["power_consumption_kwh", "solar_generation_kwh"]
#: A reading's energy at most, where the caller has no limit of its own.
MOST_KWH = 1e6
READING_COLUMNS = [*FIELDS, "sim_day", "ingested_at"]


def _usable(record: Column, most_kwh: float = MOST_KWH) -> Column:
    """Every field present and of its type, energy not negative and within its limit."""
    good = record.isNotNull()
    for name in FIELDS:
        good = good & record[name].isNotNull()
    for name in NUMBERS:
        good = good & (record[name] >= 0) & (record[name] <= most_kwh)
    return F.coalesce(good, F.lit(False))


def _parsed(records: DataFrame, wanted) -> DataFrame:
    """Records with their text and typed struct, kept where ``wanted(struct)`` holds.

    The parse is bound to a lambda variable and the test runs on that: a plain filter
    would be pushed below the projection and parse the text again for every field.
    """
    parsed = F.transform(
        F.array(F.col("value").cast("string")),
        lambda text: F.struct(
            text.alias("text"),
            F.from_json(F.when(F.ltrim(text).startswith("{"), text), RECORD_SCHEMA).alias("r")),
    )
    return records.withColumn("_p", F.explode(F.filter(parsed, lambda p: wanted(p["r"]))))


def parse_readings(records: DataFrame, timezone: str, arrival: str | Column | None = None,
                   utc: bool = True, most_kwh: float = MOST_KWH) -> DataFrame:
    """Typed readings from records with a ``value`` column (text or bytes of JSON).

    Works on static and streaming frames. Unusable records are left out; ``quarantine``
    names them. ``sim_day`` is the local date of the event. With ``utc`` the event time
    becomes NTZ in UTC, as tables hold it; a stream keeps TIMESTAMP for its watermark.
    """
    good = _parsed(records, lambda record: _usable(record, most_kwh))
    stamp = times.instant_to_utc("_p.r.timestamp")
    if arrival is None:
        arrived = times.instant_to_utc(F.current_timestamp())
    else:
        arrived = F.col(arrival) if isinstance(arrival, str) else arrival
    return good.select(
        *[F.col(f"_p.r.{name}") for name in FIELDS if name != "timestamp"],
        (stamp if utc else F.col("_p.r.timestamp")).alias("timestamp"),
        times.local_day(stamp, timezone).alias("sim_day"),
        arrived.alias("ingested_at"),
    )


def quarantine(records: DataFrame, keep: list[str] | None = None, most_kwh: float = MOST_KWH) -> DataFrame:
    """Records ``parse_readings`` leaves out, with the first reason that applies.

    Refused records are parsed once more as plain text, which tells a missing field from
    one of the wrong type; good records are parsed once only.
    """
    refused = _parsed(records, lambda record: ~_usable(record, most_kwh))
    as_text = T.StructType([T.StructField(name, T.StringType()) for name in FIELDS]
                           + [T.StructField("_broken", T.StringType())])
    text = F.col("_p.text")
    raw = refused.withColumn(
        "_t", F.from_json(text, as_text, {"columnNameOfCorruptRecord": "_broken"})
    )
    not_json = F.col("_t._broken").isNotNull() | ~F.ltrim(text).startswith("{") | text.isNull()
    reason = F.when(not_json, F.lit("payload is not a JSON object"))
    for name in FIELDS:
        reason = reason.when(F.col(f"_t.{name}").isNull(), F.lit(f"missing {name}"))
    for name in NUMBERS:
        value = F.col(f"_p.r.{name}")
        reason = reason.when(value.isNull() | (value == float("inf")) | F.isnan(value),
                             F.lit(f"{name} is not a number"))
        reason = reason.when(value < 0, F.lit(f"{name} is negative"))
        reason = reason.when(value > most_kwh, F.lit(f"{name} is above its limit"))
    reason = reason.otherwise("timestamp is not ISO-8601")
    return raw.select(*(keep or []), text.alias("value"), reason.alias("reason"))


def to_records(readings: DataFrame) -> Column:
    """JSON text of a reading, event time in ISO-8601 with offset."""
    stamp = F.concat(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    return F.to_json(F.struct(*[F.col(c) for c in FIELDS if c != "timestamp"],
                              stamp.alias("timestamp")))
