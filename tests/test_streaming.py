import json
import os
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from meterflow.operators import energy
from meterflow.settings import AlertThresholds, StreamSettings
from meterflow.sources import records, standin, streams
from meterflow.streaming import jobs
from tests.helpers import at, readings, rows

UTC = StreamSettings(timezone="UTC")


class Topic:
    """A folder of text files that grow in order."""

    def __init__(self, tmp_path):
        self.path, self.n = str(tmp_path / "topic"), 0
        os.makedirs(self.path)

    def send(self, *times, zone="a", used=1.0, meter="M-1", solar=0.0):
        lines = [json.dumps({"meter_id": meter, "household_id": "H-1", "grid_zone": zone,
                             "power_consumption_kwh": used, "solar_generation_kwh": solar,
                             "timestamp": f"2026-01-01T{t}:00Z"}) for t in times]
        name = f"{self.path}/{self.n:03d}.txt"
        with open(name, "w") as out:
            out.write("\n".join(lines) + "\n")
        os.utime(name, (time.time() - 1000 + self.n * 10,) * 2)     # files are taken by age
        self.n += 1

    def readings(self, spark):
        return records.parse_readings(streams.file_records(spark, self.path, 1), "UTC", utc=False)


def used(df, *order):
    return {r.window_start.hour: float(r.total_consumption_kwh) for r in df.collect()}


def run(query):
    query.awaitTermination()
    return query


def test_late_rows_count_until_the_watermark_passes_their_window(spark, tmp_path):
    topic = Topic(tmp_path)
    topic.send("11:10", "12:00")
    topic.send("12:01")
    topic.send("09:59", "11:25")
    windows = jobs.zone_window_stream(topic.readings(spark), UTC)
    log = jobs.ProgressLog(spark, f"{tmp_path}/p", every=2)
    spark.streams.addListener(log)
    q = run(jobs.start_metrics(windows, f"{tmp_path}/m", f"{tmp_path}/c", "late", once=True))
    assert used(jobs.metrics_view(spark, f"{tmp_path}/m")) == {11: 2.0, 12: 2.0}
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    spark.streams.removeListener(log)
    progress = log.rows().where(F.col("query_id") == q.id)
    assert progress.agg(F.sum("dropped_late")).first()[0] == 1
    assert progress.agg(F.sum("input_rows")).first()[0] == 5


def test_update_mode_reemits_and_the_newest_version_counts(spark, tmp_path):
    topic = Topic(tmp_path)
    for minute in ("00:01", "00:20", "00:40"):
        topic.send(minute)
    windows = jobs.zone_window_stream(topic.readings(spark), UTC)
    run(jobs.start_metrics(windows, f"{tmp_path}/m", f"{tmp_path}/c", "up", once=True))
    assert jobs.read_versions(spark, f"{tmp_path}/m").count() == 3
    view = jobs.metrics_view(spark, f"{tmp_path}/m")
    assert rows(view.select("total_consumption_kwh", "active_meters")) == [(Decimal("3.0000"), 1)]
    assert rows(jobs.batch_summary(view)) == [(1, 1, at("2026-01-01T00:00"))]
    for _ in range(2):
        jobs.publish_metrics(spark, f"{tmp_path}/m", f"{tmp_path}/published")
    published = spark.read.parquet(f"{tmp_path}/published")
    assert rows(published.selectExpr("total_consumption_kwh", "string(window_day)")) == [(Decimal("3.0000"), "2026-01-01")]


def test_resume_takes_only_what_is_new(spark, tmp_path):
    topic = Topic(tmp_path)

    def once():
        windows = jobs.meter_window_stream(topic.readings(spark), UTC)
        return run(jobs.start_metrics(windows, f"{tmp_path}/m", f"{tmp_path}/c", "re", once=True))

    topic.send("00:01")
    once()
    topic.send("00:02", meter="M-2")
    second = once()
    assert sum(p.numInputRows for p in second.recentProgress) == 1
    view = jobs.zone_windows_view(spark, f"{tmp_path}/m")
    assert rows(view.select("total_consumption_kwh", "active_meters")) == [(Decimal("2.0000"), 2)]


def test_final_windows_leave_the_newest_open(spark, tmp_path):
    topic = Topic(tmp_path)
    topic.send("00:10", "01:10")
    topic.send("02:40", meter="M-2")
    windows = jobs.zone_window_stream(topic.readings(spark), UTC, meters="exact")
    run(jobs.start_metrics(windows, f"{tmp_path}/m", f"{tmp_path}/c", "fin", once=True, mode="append"))
    assert used(jobs.metrics_view(spark, f"{tmp_path}/m")) == {0: 1.0, 1: 1.0}


@pytest.mark.parametrize("dedupe, total", [(True, 2.0), (False, 4.0)])
def test_replays_count_once_only_with_dedupe(spark, tmp_path, dedupe, total):
    topic = Topic(tmp_path)
    topic.send("00:10", "00:20")
    topic.send("00:10", "00:20")
    windows = jobs.meter_window_stream(topic.readings(spark), UTC, dedupe)
    run(jobs.start_metrics(windows, f"{tmp_path}/m", f"{tmp_path}/c", "dup", once=True))
    assert used(jobs.zone_windows_view(spark, f"{tmp_path}/m")) == {0: total}


def alerts_once(spark, tmp_path, topic, name="al", checkpoint="c"):
    windows = jobs.zone_window_stream(topic.readings(spark), UTC)
    return run(jobs.start_metrics_and_alerts(
        windows, f"{tmp_path}/m", f"{tmp_path}/a", f"{tmp_path}/{checkpoint}", name, "run-1", UTC,
        AlertThresholds(), once=True, mode="update"))


def test_one_alert_per_condition_across_emissions_and_restarts(spark, tmp_path):
    topic = Topic(tmp_path)
    for minute in ("12:01", "12:20", "12:40"):
        topic.send(minute, used=50.0)
    alerts_once(spark, tmp_path, topic)
    topic.send("12:50", used=50.0)
    topic.send("13:10", used=50.0)
    alerts_once(spark, tmp_path, topic)
    log = jobs.read_alerts(spark, f"{tmp_path}/a")
    expected = [(r, at(f"2026-01-01T{h}:00")) for r in ("low_renewable_contribution", "zone_overload") for h in (12, 13)]
    assert rows(log.select("rule", "window_start"), "rule", "window_start") == expected
    # from scratch under another name: the whole topic again, nothing new to log
    alerts_once(spark, tmp_path, topic, name="again", checkpoint="c2")
    assert jobs.read_alerts(spark, f"{tmp_path}/a").count() == 4


def test_a_replayed_alert_batch_writes_the_same_rows(spark, tmp_path):
    windows = energy.zone_windows(readings(spark, [(1, "a", 50, 0, "2026-01-01T12:10")]), "UTC").drop("updated_at", "readings")
    for _ in range(2):
        jobs.write_alerts(windows, f"{tmp_path}/a", "q-0", "run-1", UTC, AlertThresholds())
    jobs.write_alerts(windows, f"{tmp_path}/a", "q-1", "run-1", UTC, AlertThresholds(), horizon_windows=4)
    assert jobs.read_alerts(spark, f"{tmp_path}/a").count() == 2
    jobs.write_alerts(windows.limit(0), f"{tmp_path}/a", "q-2", "run-1", UTC, AlertThresholds())
    assert jobs.read_alerts(spark, f"{tmp_path}/a").count() == 2


def test_raw_store_keeps_good_records(spark, tmp_path):
    topic = Topic(tmp_path)
    topic.send("00:10", "23:50")
    with open(f"{topic.path}/zz.txt", "w") as out:
        out.write("not json\n")
    source = streams.file_records(spark, topic.path)
    run(jobs.start_raw_store(source, f"{tmp_path}/s", f"{tmp_path}/c", "raw", once=True))
    stored = spark.read.parquet(f"{tmp_path}/s")
    assert rows(stored.groupBy("sim_day").count().selectExpr("cast(sim_day as string)", "count"), "sim_day") == [
        ("2026-01-01", 1), ("2026-01-02", 1)]


def test_a_new_checkpoint_loses_nothing_and_its_values_win(spark, tmp_path):
    topic = Topic(tmp_path)
    topic.send("00:10", "00:20", "00:30")

    def once(life):
        source = streams.file_records(spark, topic.path)
        run(jobs.start_raw_store(source, f"{tmp_path}/s", f"{tmp_path}/raw-{life}", "raw", once=True))
        windows = jobs.zone_window_stream(topic.readings(spark), UTC)
        run(jobs.start_metrics(windows, f"{tmp_path}/m", f"{tmp_path}/c-{life}", "zones", once=True))

    once(1)
    os.remove(f"{topic.path}/000.txt")      # the source has expired what the first job took
    topic.send("00:40", "00:50", used=2.0)
    time.sleep(1.1)
    once(2)
    assert spark.read.parquet(f"{tmp_path}/s").count() == 5
    assert used(jobs.metrics_view(spark, f"{tmp_path}/m")) == {0: 4.0}


def test_a_reading_beyond_its_limit_stops_nothing(spark, tmp_path):
    topic = Topic(tmp_path)
    topic.send("00:10")
    topic.send("00:20", used=1e300)
    topic.send("00:30", used=10**30)
    windows = jobs.zone_window_stream(topic.readings(spark), UTC)
    run(jobs.start_metrics(windows, f"{tmp_path}/m", f"{tmp_path}/c", "far", once=True))
    assert used(jobs.metrics_view(spark, f"{tmp_path}/m")) == {0: 1.0}
    refused = records.quarantine(spark.read.text(topic.path))
    assert {r.reason for r in refused.collect()} == {"power_consumption_kwh is above its limit"}


def test_every_report_reads_the_live_metrics(spark, tmp_path):
    from meterflow.operators.ledger import fold
    from meterflow.plans import reports

    topic = Topic(tmp_path)
    topic.send("00:10", "01:10", "03:50")
    windows = jobs.zone_window_stream(topic.readings(spark), UTC, meters="exact")
    run(jobs.start_metrics_and_alerts(windows, f"{tmp_path}/m", f"{tmp_path}/a", f"{tmp_path}/c", "live", "r", UTC, once=True))
    view = jobs.metrics_view(spark, f"{tmp_path}/m")
    log, now = jobs.read_alerts(spark, f"{tmp_path}/a"), view.agg(F.max("updated_at")).scalar()
    runs = fold(spark.createDataFrame([], "run_id string, component string, sim_day date, at timestamp_ntz, kind string, "
                                          "status string, rows_written bigint, notes string"))
    zones = spark.createDataFrame([("a", 1)], "grid_zone string, meters bigint")
    assert reports.zones(view).count() == 1
    assert reports.health(view, zones, now).first().status == "ok"
    assert reports.metric_rows(view, log, runs, now, "billing_batch").where("name = 'zone_avg_load_kw'").count() == 1
    assert reports.status_bands(view, log, now).count() == 3


def test_periodic_trigger_runs_until_stopped(spark, tmp_path):
    topic = Topic(tmp_path)
    topic.send("00:10")
    windows = jobs.zone_window_stream(topic.readings(spark), UTC)
    q = jobs.start_metrics(windows, f"{tmp_path}/m", f"{tmp_path}/c", "tick", seconds=1)
    q.processAllAvailable()
    q.stop()
    assert used(jobs.metrics_view(spark, f"{tmp_path}/m")) == {0: 1.0}


def test_stream_equals_batch_over_many_files_in_order_of_arrival(spark, sf_dir, tmp_path):
    batch = standin.readings(spark, sf_dir)
    topic = str(tmp_path / "topic")
    slices = 6
    first, last = batch.agg(F.min("ingested_at"), F.max("ingested_at")).first()
    step = (last - first) / slices
    for n in range(slices):
        low, high = first + n * step, first + (n + 1) * step
        part = batch.where((F.col("ingested_at") >= F.lit(low).cast("timestamp_ntz"))
                           & (F.col("ingested_at") < F.lit(high).cast("timestamp_ntz")) if n < slices - 1
                           else F.col("ingested_at") >= F.lit(low).cast("timestamp_ntz"))
        part.coalesce(1).select(records.to_records(part).alias("value")).write.mode("append").text(topic)
    parsed = records.parse_readings(streams.file_records(spark, topic, 1), "Asia/Colombo", utc=False)
    q = run(jobs.start_metrics(jobs.meter_window_stream(parsed), f"{tmp_path}/m", f"{tmp_path}/c", "all", once=True))
    assert len([p for p in q.recentProgress if p.numInputRows]) == slices
    columns = ["window_start", "window_end", "grid_zone", "total_consumption_kwh", "total_solar_kwh",
               "renewable_pct", "active_meters"]
    live = jobs.zone_windows_view(spark, f"{tmp_path}/m").select(*columns)
    exact = energy.zone_windows(batch, "Asia/Colombo").select(*columns)
    assert live.exceptAll(exact).count() == 0 and exact.exceptAll(live).count() == 0
