"""Structured Streaming jobs: raw store, zone metrics, alerts.

Every sink writes a micro-batch under the query's name, its checkpoint's identity and the
batch id and overwrites only that. So a batch that runs twice leaves one copy, and a query
that begins anew with another checkpoint counts its batches from 0 without touching what
the one before it wrote. Nothing is kept in driver memory: what a job has already written
is read back from its own tables.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from meterflow.functions import amounts, times
from meterflow.operators import alerts as rules
from meterflow.operators import energy
from meterflow.settings import (AlertThresholds, METRICS_TRIGGER_SECONDS, RAW_TRIGGER_SECONDS,
                                StreamSettings)
from meterflow.sources import records, store
from meterflow.sources.streams import trigger
from meterflow.streaming import checkpoints
from meterflow.streaming.live_table import LiveTable

METRIC_KEY = ["window_start", "grid_zone"]
#: Windows after which a condition can't recur.
HORIZON_WINDOWS = 4


# -- identity ----------------------------------------------------------------

class Life:
    """What a checkpoint is called: when it was made, then its id. Names sort by age, and a
    copy of a checkpoint with its job's record has the same one."""

    def __init__(self, checkpoint: str):
        self.checkpoint, self.name = checkpoint, None

    def __call__(self, spark: SparkSession) -> str:
        if self.name is None:
            told = spark.read.text(f"{self.checkpoint.rstrip('/')}/metadata", wholetext=True).first()[0]
            self.name = f"{checkpoints.made(spark, self.checkpoint):015d}-{json.loads(told)['id']}"
        return self.name


# -- raw store ---------------------------------------------------------------

def start_raw_store(source: DataFrame, path: str, checkpoint: str, name: str,
                    settings: StreamSettings = StreamSettings(), once: bool = False,
                    seconds: int = RAW_TRIGGER_SECONDS, arrival: str | None = None) -> StreamingQuery:
    """Stream of raw records to the partitioned store, append mode."""
    parsed, life = records.parse_readings(source, settings.timezone, arrival), Life(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        store.write_batch(batch, path, f"{name}-{life(batch.sparkSession)}-{batch_id}")

    return (parsed.writeStream.queryName(name).outputMode("append").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(**trigger(once, seconds)).start())


# -- windows -----------------------------------------------------------------

def _window(settings: StreamSettings) -> Column:
    length = f"{settings.window_minutes} minutes"
    shift = times.window_shift_minutes(settings.timezone, settings.window_minutes)
    return F.window("timestamp", length, length, f"{shift} minutes")


def watermarked(readings: DataFrame, settings: StreamSettings, dedupe: bool = False) -> DataFrame:
    """Readings with their watermark; ``dedupe`` also drops replays seen within it."""
    marked = readings.withWatermark("timestamp", f"{settings.watermark_minutes} minutes")
    if dedupe:
        return marked.dropDuplicatesWithinWatermark(["meter_id", "timestamp"])
    return marked


def zone_window_stream(readings: DataFrame, settings: StreamSettings = StreamSettings(),
                       meters: str = "approx", dedupe: bool = False) -> DataFrame:
    """Zone windows from a stream (event time in a TIMESTAMP column).

    ``approx``: one stateful step with a meter sketch, for update or append mode;
    ``sketch`` also keeps the sketch as a column.
    ``exact``: a window is first kept per meter and then summed per zone, which counts
    meters exactly, splits a large zone's state by meter, and runs in append mode.
    """
    rows = watermarked(readings, settings, dedupe)
    if meters in ("approx", "sketch"):
        totals = energy.aggregate_energy(rows, [_window(settings).alias("w"), "grid_zone"], meters)
    else:
        per_meter = rows.groupBy(_window(settings).alias("w"), "grid_zone", "meter_id").agg(
            amounts.sum_fine("power_consumption_kwh").alias("used"),
            amounts.sum_fine("solar_generation_kwh").alias("solar"))
        totals = per_meter.groupBy("w", "grid_zone").agg(
            amounts.fine_to_kwh(F.sum("used")).alias("total_consumption_kwh"),
            amounts.fine_to_kwh(F.sum("solar")).alias("total_solar_kwh"),
            F.count(F.lit(1)).alias("active_meters"))
    return energy.with_renewable_pct(totals).select(
        times.instant_to_utc("w.start").alias("window_start"),
        times.instant_to_utc("w.end").alias("window_end"),
        "grid_zone", "total_consumption_kwh", "total_solar_kwh", "renewable_pct", "active_meters",
        *(["meters_sketch"] if meters == "sketch" else []),
    )


def meter_window_stream(readings: DataFrame, settings: StreamSettings = StreamSettings(),
                        dedupe: bool = False) -> DataFrame:
    """Windows per zone and meter, for update mode; ``zone_windows_view`` sums them up.

    Keeps exact meter counts in update mode without a growing set in the state.
    """
    rows = watermarked(readings, settings, dedupe)
    per_meter = rows.groupBy(_window(settings).alias("w"), "grid_zone", "meter_id").agg(
        amounts.sum_fine("power_consumption_kwh").alias("used_units"),
        amounts.sum_fine("solar_generation_kwh").alias("solar_units"))
    return per_meter.select(
        times.instant_to_utc("w.start").alias("window_start"),
        times.instant_to_utc("w.end").alias("window_end"),
        "grid_zone", "meter_id", "used_units", "solar_units",
    )


# -- keyed result tables -----------------------------------------------------

def write_version(batch: DataFrame, path: str, name: str, life: str, batch_id: int) -> None:
    """Adds a batch with its write time to a versioned table; the same batch again replaces itself."""
    stamp = times.instant_to_utc(F.current_timestamp()).alias("updated_at")
    batch.select("*", stamp).write.mode("overwrite").parquet(f"{path}/query={name}/life={life}/batch_id={batch_id}")


def read_versions(spark: SparkSession, path: str, name: str = "*") -> DataFrame | None:
    """All versions of a query's table; without a name, of the one query that writes there."""
    try:
        return spark.read.option("basePath", path).parquet(f"{path}/query={name}/life=*/batch_id=*")
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def metrics_view(spark: SparkSession, path: str, key: list[str] | None = None, name: str = "*") -> DataFrame:
    """Newest version of each window of one query's table: the youngest checkpoint's last batch.

    What has been compacted is read from the table's base.
    """
    return LiveTable(spark, path, key or METRIC_KEY).read(None if name == "*" else name)


def publish_metrics(spark: SparkSession, path: str, target: str, key: list[str] | None = None) -> None:
    """Newest versions as a plain table by window day, for readers of long-running jobs.

    A versioned table grows by one folder per micro-batch; this one holds each window once
    and a report on some days reads those days.
    """
    newest = metrics_view(spark, path, key).withColumn("window_day", F.to_date("window_start"))
    (newest.hint("rebalance", "window_day").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("window_day").parquet(target))


def zone_windows_view(spark: SparkSession, path: str) -> DataFrame:
    """Zone windows from the newest version of each meter's window."""
    latest = metrics_view(spark, path, ["window_start", "grid_zone", "meter_id"])
    totals = latest.groupBy("window_start", "window_end", "grid_zone").agg(
        amounts.fine_to_kwh(F.sum("used_units")).alias("total_consumption_kwh"),
        amounts.fine_to_kwh(F.sum("solar_units")).alias("total_solar_kwh"),
        F.count(F.lit(1)).alias("active_meters"), F.max("updated_at").alias("updated_at"))
    return energy.with_renewable_pct(totals)


def start_metrics(windows: DataFrame, path: str, checkpoint: str, name: str, once: bool = False,
                  mode: str = "update", seconds: int = METRICS_TRIGGER_SECONDS,
                  settings: StreamSettings | None = None) -> StreamingQuery:
    """Windows into a versioned table; each batch also gets its write time.

    With the ``settings`` that the windows were cut by, a checkpoint that other ones have
    made is refused.
    """
    if settings is not None:
        checkpoints.admit(windows.sparkSession, checkpoint, settings)
    life = Life(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_version(batch, path, name, life(batch.sparkSession), batch_id)

    return (windows.writeStream.queryName(name).outputMode(mode).foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(**trigger(once, seconds)).start())


# -- alerts ------------------------------------------------------------------

ALERT_SCHEMA = T.StructType([
    T.StructField("window_start", T.TimestampNTZType()),
    T.StructField("grid_zone", T.StringType()),
    T.StructField("level", T.StringType()),
    T.StructField("rule", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("run_id", T.StringType()),
])


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """The alert log, empty before the first batch."""
    try:
        return spark.read.schema(
            T.StructType([*ALERT_SCHEMA, T.StructField("alert_day", T.DateType()),
                          T.StructField("batch", T.StringType())])
        ).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ALERT_SCHEMA).withColumns(
            {"alert_day": F.lit(None).cast("date"), "batch": F.lit(None).cast("string")})


def write_alerts(windows: DataFrame, path: str, batch: str, run_id: str, settings: StreamSettings,
                 limits: AlertThresholds, horizon_windows: int | None = None) -> None:
    """Evaluates the rules on a batch of windows and logs conditions not logged before.

    What is logged is read from the table, so a restart repeats nothing; rows of this same
    batch are ignored, so a replay writes the same rows again. The log is partitioned by
    window day, and only days the batch reaches back to are read. ``horizon_windows``
    bounds how far back, for update mode where a window can only recur while it is open.
    """
    spark = windows.sparkSession
    raised = rules.evaluate(windows, settings.timezone, limits, settings.window_minutes)
    oldest = windows.agg(F.min("window_start")).first()[0]
    log = read_alerts(spark, path).where(F.col("batch") != batch)
    if oldest is not None:
        reach = F.lit(oldest).cast("timestamp_ntz")
        if horizon_windows:
            reach = reach - F.make_dt_interval(mins=F.lit(horizon_windows * settings.window_minutes))
        log = log.where(F.col("alert_day") >= F.to_date(reach))
    _log(rules.not_yet_raised(raised, log), path, batch, run_id)


def _log(fresh: DataFrame, path: str, batch: str, run_id: str) -> None:
    stamped = fresh.select(
        "window_start", "grid_zone", "level", "rule", "message",
        times.instant_to_utc(F.current_timestamp()).alias("ts"), F.lit(run_id).alias("run_id"),
        F.to_date("window_start").alias("alert_day"), F.lit(batch).alias("batch"),
    )
    (stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("alert_day", "batch").parquet(path))


def start_metrics_and_alerts(windows: DataFrame, metrics_path: str, alerts_path: str,
                             checkpoint: str, name: str, run_id: str,
                             settings: StreamSettings = StreamSettings(),
                             limits: AlertThresholds = AlertThresholds(), once: bool = False,
                             mode: str = "append", seconds: int = METRICS_TRIGGER_SECONDS,
                             horizon_windows: int | None = None) -> StreamingQuery:
    """Windows to the metrics table, then their alerts to the log.

    In append mode the rules see finished windows only. Update mode also sees windows that
    are still filling and warns earlier, at the price of warnings a full window would not
    raise. Metrics go first; both writes are safe to repeat. A checkpoint made with other
    settings is refused.
    """
    checkpoints.admit(windows.sparkSession, checkpoint, settings)
    life = Life(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            own = life(batch.sparkSession)
            write_version(batch, metrics_path, name, own, batch_id)
            write_alerts(batch, alerts_path, f"{name}-{own}-{batch_id}", run_id, settings, limits, horizon_windows)
        finally:
            batch.unpersist()

    return (windows.writeStream.queryName(name).outputMode(mode).foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(**trigger(once, seconds)).start())


# -- alerts with their memory in the stream ----------------------------------

def versions_stream(spark: SparkSession, path: str, name: str, windows: T.StructType) -> DataFrame:
    """The rows that a metrics job writes, as a stream: each version of a window once.

    ``windows`` is the schema the job writes, without its write time. A batch that was done
    again has replaced its files, so missing ones are passed over and the new ones taken.
    """
    schema = T.StructType([*windows, T.StructField("updated_at", T.TimestampNTZType())])
    return (spark.readStream.schema(schema).option("recursiveFileLookup", "true")
            .option("ignoreMissingFiles", "true").parquet(f"{path}/query={name}"))


def raised_once(versions: DataFrame, settings: StreamSettings = StreamSettings(),
                limits: AlertThresholds = AlertThresholds(), horizon_windows: int = HORIZON_WINDOWS) -> DataFrame:
    """The first breach of each rule, zone and window in a stream of window versions.

    The conditions seen are the stream's state. One is forgotten when the newest window
    is ``horizon_windows`` after it: half of that passes until the watermark reaches it, half
    until its memory runs out. Windows are updated for their length and the metrics' own
    watermark only, so the watermark here is never shorter.
    """
    half = -(-horizon_windows * settings.window_minutes // 2)
    delay = f"{max(half, settings.window_minutes + settings.watermark_minutes)} minutes"
    marked = versions.withColumn("at", times.utc_to_instant("window_start")).withWatermark("at", delay)
    raised = rules.evaluate(marked, settings.timezone, limits, settings.window_minutes, keep=["at"])
    return raised.dropDuplicatesWithinWatermark(rules.IDENTITY)


def start_early_alerts(versions: DataFrame, path: str, checkpoint: str, name: str, run_id: str,
                       settings: StreamSettings = StreamSettings(), limits: AlertThresholds = AlertThresholds(),
                       once: bool = False, seconds: int = METRICS_TRIGGER_SECONDS,
                       horizon_windows: int = HORIZON_WINDOWS) -> StreamingQuery:
    """Alerts on windows as they fill, each condition logged once, also after a restart.

    Runs beside the metrics job, in update mode, whose versions it reads. The log is only
    added to; nothing of it is read.
    """
    life = Life(checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        _log(batch, path, f"{name}-{life(batch.sparkSession)}-{batch_id}", run_id)

    raised = raised_once(versions, settings, limits, horizon_windows)
    return (raised.writeStream.queryName(name).outputMode("append").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(**trigger(once, seconds)).start())


# -- progress ----------------------------------------------------------------

def batch_summary(windows: DataFrame) -> DataFrame:
    """What a micro-batch touched: rows, zones, newest window."""
    return windows.agg(F.count(F.lit(1)).alias("windows"),
                       F.count_distinct("grid_zone").alias("zones"),
                       F.max("window_start").alias("newest_window"))


PROGRESS = ("query_id string, batch_id bigint, input_rows bigint, input_rows_per_second double, "
            "processed_rows_per_second double, duration_ms bigint, dropped_late bigint")


class ProgressLog(StreamingQueryListener):
    """Appends every progress report of the session's queries to a table.

    A query itself keeps only its last reports. Lines wait for ``every`` of them, or for
    the end of a query, and go out in one file, so little is held and no report is lost.
    """

    def __init__(self, spark: SparkSession, path: str, every: int = 100):
        self.spark, self.path, self.every = spark, path, every
        self.lines: list[tuple] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.lines.append((
            str(p.id), p.batchId, int(p.numInputRows), float(p.inputRowsPerSecond or 0.0),
            float(p.processedRowsPerSecond or 0.0), int(p.batchDuration),
            int(sum(s.numRowsDroppedByWatermark for s in p.stateOperators))))
        if len(self.lines) >= self.every:
            self.flush()

    def onQueryTerminated(self, event) -> None:
        self.flush()

    def flush(self) -> None:
        lines, self.lines = self.lines, []
        if lines:
            self.spark.createDataFrame(lines, PROGRESS).coalesce(1).write.mode("append").parquet(self.path)

    def rows(self) -> DataFrame:
        """All reports so far, one per micro-batch."""
        self.flush()
        return self.spark.read.schema(PROGRESS).parquet(self.path)
