"""The live jobs run end to end over the given tables.

Records are written to a topic folder in order of arrival, in a few deliveries; after
each delivery the job resumes from its checkpoint, takes what is new and stops. The
result is read from the job's tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterflow.operators.energy import aggregate_energy
from meterflow.settings import StreamSettings
from meterflow.sources import records, standin, streams as sources
from meterflow.streaming import checkpoints, jobs, silence
from meterflow.streaming.live_table import LiveTable
from meterflow.workspace import shared_folder

DELIVERIES = 2
SETTINGS = StreamSettings()


def _deliveries(rows: DataFrame, topic: str):
    """Writes the records arrival slice by arrival slice; yields after each.

    Only the two ends of the arrival span come to the driver.
    """
    first, last = rows.agg(F.min("ingested_at"), F.max("ingested_at")).first()
    step = (last - first) / DELIVERIES
    for n in range(DELIVERIES):
        begin, end = first + n * step, first + (n + 1) * step
        part = rows.where(F.col("ingested_at") >= F.lit(begin).cast("timestamp_ntz"))
        if n < DELIVERIES - 1:
            part = part.where(F.col("ingested_at") < F.lit(end).cast("timestamp_ntz"))
        part.select(F.col("value").cast("string")).write.mode("append").text(topic)
        yield n


def _records(spark: SparkSession, sf_dir: str, resent: bool = False) -> DataFrame:
    readings = standin.readings(spark, sf_dir, resent=resent)
    return readings.select("ingested_at", records.to_records(readings).alias("value"))


def _run(spark, rows: DataFrame, start, label: str, after=None) -> str:
    """Drives a job over the deliveries; ``start(source, folder)`` starts one run and
    ``after(folder, delivery)`` follows it."""
    folder = shared_folder(spark, label)
    topic = f"{folder}/topic"
    for n in _deliveries(rows, topic):
        source = sources.file_records(spark, topic)
        start(source, folder).awaitTermination()
        if after:
            after(folder, n)
    return folder


def _parsed(source: DataFrame) -> DataFrame:
    return records.parse_readings(source, SETTINGS.timezone, utc=False)


def raw_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, meters and energy per day and zone of the store the raw job writes."""
    def start(source, folder):
        return jobs.start_raw_store(source, f"{folder}/store", f"{folder}/checkpoint",
                                    "raw_store", once=True)

    folder = _run(spark, standin.raw_records(spark, sf_dir), start, "raw-store")
    stored = spark.read.parquet(f"{folder}/store")
    return aggregate_energy(stored, ["sim_day", "grid_zone"],
                            extra=[F.count(F.lit(1)).alias("rows")])


def zone_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update mode: every changed window is written again, the newest version counts."""
    def start(source, folder):
        windows = jobs.meter_window_stream(_parsed(source), SETTINGS)
        return jobs.start_metrics(windows, f"{folder}/metrics", f"{folder}/checkpoint",
                                  "zone_windows", once=True)

    folder = _run(spark, _records(spark, sf_dir), start, "zone-windows")
    return jobs.zone_windows_view(spark, f"{folder}/metrics").drop("updated_at")


def final_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append mode: a window is written once, when the watermark has passed it."""
    def start(source, folder):
        windows = jobs.zone_window_stream(_parsed(source), SETTINGS, meters="exact")
        return jobs.start_metrics(windows, f"{folder}/metrics", f"{folder}/checkpoint",
                                  "final_windows", once=True, mode="append")

    folder = _run(spark, _records(spark, sf_dir), start, "final-windows")
    return jobs.metrics_view(spark, f"{folder}/metrics").drop("updated_at")


def dedup_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update mode over a topic with resent records, which are counted once."""
    def start(source, folder):
        windows = jobs.meter_window_stream(_parsed(source), SETTINGS, dedupe=True)
        return jobs.start_metrics(windows, f"{folder}/metrics", f"{folder}/checkpoint",
                                  "dedup_windows", once=True)

    folder = _run(spark, _records(spark, sf_dir, resent=True), start, "dedup-windows")
    return jobs.zone_windows_view(spark, f"{folder}/metrics").drop("updated_at")


def new_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw store of a job that loses its checkpoint half-way.

    The first job takes one half. The second one begins with a new checkpoint over a topic
    that has expired that half and holds the other; nothing stored before may go.
    """
    folder = shared_folder(spark, "new-checkpoint")
    rows = _records(spark, sf_dir)
    first, last = rows.agg(F.min("ingested_at"), F.max("ingested_at")).first()
    middle = F.lit(first + (last - first) / 2).cast("timestamp_ntz")
    for n, part in enumerate((rows.where(F.col("ingested_at") < middle), rows.where(F.col("ingested_at") >= middle))):
        topic = f"{folder}/topic-{n}"
        part.select("value").write.text(topic)
        jobs.start_raw_store(sources.file_records(spark, topic), f"{folder}/store", f"{folder}/checkpoint-{n}",
                             "raw_store", once=True).awaitTermination()
    stored = spark.read.parquet(f"{folder}/store")
    return aggregate_energy(stored, ["sim_day", "grid_zone"], extra=[F.count(F.lit(1)).alias("rows")])


def alert_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alert log over finished windows."""
    def start(source, folder):
        windows = jobs.zone_window_stream(_parsed(source), SETTINGS, meters="exact")
        return jobs.start_metrics_and_alerts(
            windows, f"{folder}/metrics", f"{folder}/alerts", f"{folder}/checkpoint", "alerts",
            run_id="speed-1", settings=SETTINGS, limits=standin.THRESHOLDS, once=True)

    folder = _run(spark, _records(spark, sf_dir), start, "alerts")
    return jobs.read_alerts(spark, f"{folder}/alerts").select(
        "window_start", "grid_zone", "level", "rule", "message", "run_id")


def compacted_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Update mode with the first delivery's windows merged into the table's base, old
    batches removed, and the second delivery's read from the batches after it."""
    def start(source, folder):
        windows = jobs.meter_window_stream(_parsed(source), SETTINGS)
        return jobs.start_metrics(windows, f"{folder}/metrics", f"{folder}/checkpoint", "compacted", once=True)

    def after(folder, n):
        table = LiveTable(spark, f"{folder}/metrics", [*jobs.METRIC_KEY, "meter_id"])
        if n < DELIVERIES - 1 and table.compact():
            table.vacuum(keep=1)

    folder = _run(spark, _records(spark, sf_dir), start, "compacted", after)
    return jobs.zone_windows_view(spark, f"{folder}/metrics").drop("updated_at")


def early_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log of alerts on windows that still fill, each condition at its first breach.

    Two jobs: one writes window versions in update mode, the other follows them.
    """
    def start(source, folder):
        windows = jobs.zone_window_stream(_parsed(source), SETTINGS, meters="sketch")
        jobs.start_metrics(windows, f"{folder}/metrics", f"{folder}/checkpoint", "windows", once=True).awaitTermination()
        versions = jobs.versions_stream(spark, f"{folder}/metrics", "windows", windows.schema)
        return jobs.start_early_alerts(versions, f"{folder}/alerts", f"{folder}/checkpoint-alerts", "early", "speed-1",
                                       SETTINGS, standin.THRESHOLDS, once=True)

    folder = _run(spark, _records(spark, sf_dir), start, "early-alerts")
    return jobs.read_alerts(spark, f"{folder}/alerts").select(
        "window_start", "grid_zone", "level", "rule", "message", "run_id")


def no_data(spark: SparkSession, sf_dir: str, limit_seconds: int = 2 * 3600) -> DataFrame:
    """Silences per zone as the live job logs them, with those that last at the end."""
    folder = shared_folder(spark, "no-data")
    rows = _records(spark, sf_dir)
    first, last = rows.agg(F.min("ingested_at"), F.max("ingested_at")).first()
    middle = F.lit(first + (last - first) / 2).cast("timestamp_ntz")
    for part in (rows.where(F.col("ingested_at") < middle), rows.where(F.col("ingested_at") >= middle)):
        part.write.mode("append").parquet(f"{folder}/topic")
        topic = spark.readStream.schema(rows.schema).parquet(f"{folder}/topic")
        readings = records.parse_readings(topic, SETTINGS.timezone, arrival="ingested_at", utc=False)
        found = silence.silences(readings, limit_seconds)
        silence.start_silences(found, f"{folder}/log", f"{folder}/checkpoint", "no_data", once=True).awaitTermination()
    return silence.silence_log(spark.read.schema(found.schema).parquet(f"{folder}/log"))


def checkpoint_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the checkpoint of a job with dedupe tells of its settings, compared with its own
    and with others, and how many rows its steps hold at the end."""
    def start(source, folder):
        windows = jobs.meter_window_stream(_parsed(source), SETTINGS, dedupe=True)
        return jobs.start_metrics(windows, f"{folder}/metrics", f"{folder}/checkpoint", "fit", once=True, settings=SETTINGS)

    place = f"{_run(spark, _records(spark, sf_dir, resent=True), start, 'fit')}/checkpoint"
    steps = ["stateStoreSave", "dedupeWithinWatermark"]
    own = checkpoints.fitness(spark, place, SETTINGS, steps).withColumn("settings", F.lit("own"))
    changed = StreamSettings(timezone="UTC", window_minutes=30, watermark_minutes=45)
    other = checkpoints.fitness(spark, place, changed, steps[:1]).withColumn("settings", F.lit("other"))
    rows = checkpoints.state_rows(spark, place).select(
        F.concat(F.lit("rows of "), F.col("operator")).alias("check"), F.col("rows").cast("string").alias("found"),
        F.lit(None).cast("string").alias("expected"), F.lit(None).cast("boolean").alias("fits"), F.lit("").alias("settings"))
    return own.unionByName(other).unionByName(rows)


def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of a job that is sent the first half's error events with the second half: those
    whose window the watermark has passed by then are left out, the others still count."""
    folder = shared_folder(spark, "late-rows")
    readings = standin.readings(spark, sf_dir)
    rows = readings.select("ingested_at", "event_type", records.to_records(readings).alias("value"))
    first, last = rows.agg(F.min("ingested_at"), F.max("ingested_at")).first()
    on_time = (F.col("ingested_at") < F.lit(first + (last - first) / 2).cast("timestamp_ntz")) & (F.col("event_type") != "error")
    for part in (rows.where(on_time), rows.where(~on_time)):
        part.select("value").write.mode("append").text(f"{folder}/topic")
        windows = jobs.meter_window_stream(_parsed(sources.file_records(spark, f"{folder}/topic")), SETTINGS)
        jobs.start_metrics(windows, f"{folder}/metrics", f"{folder}/checkpoint", "late_rows", once=True, settings=SETTINGS).awaitTermination()
    return jobs.zone_windows_view(spark, f"{folder}/metrics").drop("updated_at")
