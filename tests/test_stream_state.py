"""Conditions and silences that streams remember: alerts once, silence while it lasts."""

import os

import pytest

from meterflow.operators import energy
from meterflow.settings import AlertThresholds, StreamSettings
from meterflow.streaming import jobs, silence
from tests.helpers import at, plan, readings, rows
from tests.test_streaming import Topic, run

UTC = StreamSettings(timezone="UTC")


def early(spark, tmp_path, topic, horizon=4):
    """One run of both jobs over what is new."""
    windows = jobs.zone_window_stream(topic.readings(spark), UTC, meters="sketch")
    run(jobs.start_metrics(windows, f"{tmp_path}/m", f"{tmp_path}/c", "w", once=True))
    versions = jobs.versions_stream(spark, f"{tmp_path}/m", "w", windows.schema)
    return run(jobs.start_early_alerts(versions, f"{tmp_path}/a", f"{tmp_path}/ca", "early", "run-1", UTC,
                                       AlertThresholds(), once=True, horizon_windows=horizon))


def logged(spark, tmp_path):
    return rows(jobs.read_alerts(spark, f"{tmp_path}/a").where("rule = 'zone_overload'").select("window_start", "message"), "window_start")


def test_a_filling_window_warns_once_across_versions_and_restarts(spark, tmp_path):
    topic = Topic(tmp_path)
    topic.send("02:01", used=1.0)
    early(spark, tmp_path, topic)
    assert logged(spark, tmp_path) == []
    topic.send("02:10", used=9.0)
    early(spark, tmp_path, topic)
    first = logged(spark, tmp_path)
    assert [r[0] for r in first] == [at("2026-01-01T02:00")] and "10.00 kW/meter across 1 meters" in first[0][1]
    for minute in ("02:20", "02:30"):
        topic.send(minute, used=9.0)
        early(spark, tmp_path, topic)
    assert logged(spark, tmp_path) == first
    topic.send("03:05", used=9.0)
    early(spark, tmp_path, topic)
    assert [r[0].hour for r in logged(spark, tmp_path)] == [2, 3]


def test_conditions_are_forgotten_as_time_goes_on(spark, tmp_path):
    topic, kept = Topic(tmp_path), []
    for hour in range(0, 20, 2):
        topic.send(f"{hour:02d}:30", used=9.0)
        query = early(spark, tmp_path, topic)
        kept.append(query.lastProgress.stateOperators[0].numRowsTotal)
    assert len(logged(spark, tmp_path)) == 10
    assert max(kept) <= 2 * 3 and kept[-1] < max(kept), kept   # two rules by day, three windows each


def test_a_batch_done_again_does_not_warn_again(spark, tmp_path):
    topic = Topic(tmp_path)
    topic.send("02:01", used=9.0)
    early(spark, tmp_path, topic)
    first = logged(spark, tmp_path)
    again = next(p for p, _, files in os.walk(f"{tmp_path}/m") if "_SUCCESS" in files and any(
        f.endswith(".parquet") and spark.read.parquet(f"{p}/{f}").count() for f in files))
    copy = spark.createDataFrame(spark.read.parquet(again).collect(), spark.read.parquet(again).schema)
    copy.write.mode("overwrite").parquet(again)
    early(spark, tmp_path, topic)
    assert logged(spark, tmp_path) == first


# -- silence -----------------------------------------------------------------

class Arrivals:
    """Arrivals (zone, minute of the day) delivered to the silence job."""

    def __init__(self, spark, tmp_path, limit=3600, hold=0):
        self.spark, self.path, self.limit, self.hold = spark, str(tmp_path), limit, hold

    def send(self, *arrivals):
        frame = self.spark.createDataFrame([(z, at(f"2026-01-01T{m // 60:02d}:{m % 60:02d}:30")) for z, m in arrivals],
                                           "grid_zone string, ingested_at timestamp_ntz").coalesce(1)
        frame.write.mode("append").parquet(f"{self.path}/topic")
        source = self.spark.readStream.schema(frame.schema).parquet(f"{self.path}/topic")
        found = silence.silences(source, self.limit, self.hold)
        run(silence.start_silences(found, f"{self.path}/log", f"{self.path}/c", "quiet", once=True))
        self.log = self.spark.read.schema(found.schema).parquet(f"{self.path}/log")

    def lines(self):
        return sorted(((r.grid_zone, r.silent_since.strftime("%H:%M"), r.heard_at and r.heard_at.strftime("%H:%M")) for r in self.log.collect()), key=repr)


def test_silence_is_told_while_it_lasts_and_once_more_when_it_ends(spark, tmp_path):
    a = Arrivals(spark, tmp_path)
    a.send(("a", 0), ("b", 0), ("b", 30))
    assert a.lines() == []
    a.send(("b", 55), ("b", 62))
    assert a.lines() == []                                  # an hour and one minute, less five of watermark
    a.send(("b", 70))
    assert a.lines() == [("a", "00:00", None)]              # a has said nothing since, b moves the time
    a.send(("b", 100), ("b", 130))
    assert a.lines() == [("a", "00:00", None)]              # not told again
    a.send(("a", 135), ("b", 145), ("b", 150))
    assert a.lines() == [("a", "00:00", "02:15"), ("a", "00:00", None)]
    assert rows(silence.silence_log(a.log).select("gap_seconds")) == [(8100,)]
    a.send(("b", 200), ("b", 230))
    assert a.lines()[-1] == ("a", "02:15", None)
    assert rows(silence.silence_log(a.log).orderBy("gap_start").select("gap_seconds")) == [(8100,), (None,)]


def test_hold_time_and_several_gaps_in_one_batch(spark, tmp_path):
    a = Arrivals(spark, tmp_path, limit=3600, hold=600)
    a.send(("a", 0), ("a", 65), ("a", 140), ("a", 141), ("a", 300), ("a", 310), ("b", 320))
    assert a.lines() == [("a", "01:05", "02:20"), ("a", "02:21", "05:00")]
    with pytest.raises(ValueError):
        silence.silences(a.log, 30)


# -- sketches ----------------------------------------------------------------

def test_rolled_up_sketches_count_meters_once_without_readings(spark, tmp_path):
    # 3000 meters, each in every window of its zone
    given = readings(spark, []).unionByName(spark.range(12_000).selectExpr(
        "concat('M-', id % 3000) AS meter_id", "concat('H-', id % 3000) AS household_id", "IF(id % 3000 < 2000, 'a', 'b') AS grid_zone",
        "1.5D AS power_consumption_kwh", "0.5D AS solar_generation_kwh",
        "timestamp_ntz'2026-01-01 00:10:00' + make_dt_interval(0, int(id / 3000)) AS timestamp", "timestamp_ntz'2026-01-01 05:00:00' AS ingested_at",
        "date'2026-01-01' AS sim_day"))
    energy.zone_windows(given, "UTC", meters="sketch").write.parquet(f"{tmp_path}/w")
    windows = spark.read.parquet(f"{tmp_path}/w")
    assert windows.count() == 8
    zones = energy.rolled_up(windows, ["grid_zone"])
    found = {r.grid_zone: r for r in zones.collect()}
    assert abs(found["a"].active_meters - 2000) < 100 and abs(found["b"].active_meters - 1000) < 50
    assert float(found["a"].total_consumption_kwh) == 12_000 and float(found["b"].renewable_pct) == pytest.approx(33.33)
    grid, direct = energy.rolled_up(zones, []).first(), energy.rolled_up(windows, []).first()
    assert abs(grid.active_meters - 3000) < 150 and grid.active_meters == direct.active_meters and float(grid.total_solar_kwh) == 6000
    assert plan(zones).split("== Initial Plan ==")[0].count("FileScan") == 1


def test_small_numbers_of_meters_are_exact(spark):
    given = readings(spark, [(m, "a", 1, 0, f"2026-01-01T0{h}:10") for m in range(300) for h in range(2)])
    windows = energy.zone_windows(given, "UTC", meters="sketch")
    assert rows(windows.select("active_meters").distinct()) == [(300,)]
    assert energy.rolled_up(windows, []).first().active_meters == 300
    with pytest.raises(ValueError):
        energy.zone_windows(given, "UTC", meters="some")
