"""Silence of a zone, noticed while it lasts.

Arrivals are reduced to one line per zone and minute before they meet in a zone's state,
which holds the last arrival and one timer. The timer fires when the stream's own time, the
newest arrival of all zones less the watermark, has passed the last arrival by the limit and
the hold time. So a silence is reported while the zone is silent, and once more with its end
when the zone is heard again.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from meterflow.functions import times
from meterflow.sources.streams import trigger
from meterflow.settings import METRICS_TRIGGER_SECONDS

#: Width of the lines that arrivals are reduced to; a silence is longer.
LINE_SECONDS = 60

REPORT = "grid_zone string, silent_since bigint, heard_at bigint"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class ZoneSilence(StatefulProcessor):
    """Per zone the last arrival and a timer for when its silence counts; times in microseconds."""

    def __init__(self, most: int):
        self.most = most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at bigint")

    def _due(self, last: int) -> int:
        return (last + self.most) // 1000 + 1

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last = self.last.get()[0] if self.last.exists() else None
        before = last
        for first_at, last_at in sorted((r["first_at"], r["last_at"]) for r in rows):
            if last is not None and first_at - last > self.most:
                yield Row(grid_zone=key[0], silent_since=last, heard_at=first_at)
            last = last_at if last is None else max(last, last_at)
        if last != before:
            if before is not None:
                self.handle.deleteTimer(self._due(before))
            self.last.update((last,))
            self.handle.registerTimer(self._due(last))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield Row(grid_zone=key[0], silent_since=self.last.get()[0], heard_at=None)

    def close(self) -> None:
        pass


def silences(readings: DataFrame, limit_seconds: int, hold_seconds: int = 0, watermark_minutes: int = 5,
             line_seconds: int = LINE_SECONDS) -> DataFrame:
    """grid_zone, silent_since and heard_at (null while the silence lasts) of every silence
    longer than limit and hold time, from a stream of readings with ``ingested_at``.

    A silence that is still on when it is noticed makes a line, and its end another one.
    """
    if limit_seconds + hold_seconds < line_seconds:
        raise ValueError(f"a silence must be longer than {line_seconds} s, the width of a line")
    arrived = readings.select("grid_zone", times.utc_to_instant("ingested_at").alias("at"))
    lines = (arrived.withWatermark("at", f"{watermark_minutes} minutes")
             .groupBy(F.window("at", f"{line_seconds} seconds").alias("w"), "grid_zone")
             .agg(F.min(F.unix_micros("at")).alias("first_at"), F.max(F.unix_micros("at")).alias("last_at")))
    found = lines.select("grid_zone", "first_at", "last_at", F.window_time("w").alias("line")).groupBy("grid_zone").transformWithState(
        ZoneSilence((limit_seconds + hold_seconds) * 1_000_000), REPORT, "Append", "EventTime")
    moment = {c: times.instant_to_utc(F.timestamp_micros(c)) for c in ("silent_since", "heard_at")}
    return found.select("grid_zone", *[v.alias(c) for c, v in moment.items()])


def start_silences(found: DataFrame, path: str, checkpoint: str, name: str, once: bool = False,
                   seconds: int = METRICS_TRIGGER_SECONDS) -> StreamingQuery:
    """Appends the lines to a table; Spark's file sink keeps each micro-batch once.

    Timers need the RocksDB state store, which a query takes from its session's settings as
    it starts; the session gets back what it had.
    """
    conf, setting = found.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(setting)
    conf.set(setting, STORE)
    try:
        return (found.writeStream.queryName(name).outputMode("append").format("parquet").option("path", path)
                .option("checkpointLocation", checkpoint).trigger(**trigger(once, seconds)).start())
    finally:
        conf.set(setting, before)


def silence_log(lines: DataFrame) -> DataFrame:
    """One row per silence: its end and length are null while it lasts."""
    log = lines.groupBy("grid_zone", "silent_since").agg(F.max("heard_at").alias("heard_at"))
    return log.select("grid_zone", F.col("silent_since").alias("gap_start"), F.col("heard_at").alias("gap_end"),
                      F.timestamp_diff("SECOND", "silent_since", "heard_at").alias("gap_seconds"))
