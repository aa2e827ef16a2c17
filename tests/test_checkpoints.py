"""A job goes on only from a checkpoint that its settings have made."""

import shutil

import pytest
from pyspark.sql import functions as F

from meterflow.settings import StreamSettings
from meterflow.streaming import checkpoints, jobs
from tests.helpers import rows
from tests.test_streaming import Topic, run, used

UTC = StreamSettings(timezone="UTC")


def windows_of(spark, topic, settings, dedupe=False):
    return jobs.meter_window_stream(topic.readings(spark), settings, dedupe)


def once(spark, tmp_path, topic, settings=UTC, checkpoint="c", dedupe=False, recorded=True):
    return run(jobs.start_metrics(windows_of(spark, topic, settings, dedupe), f"{tmp_path}/m", f"{tmp_path}/{checkpoint}", "fit",
                                  once=True, settings=settings if recorded else None))


@pytest.mark.parametrize("changed, told", [
    (StreamSettings(timezone="UTC", window_minutes=30), "window_minutes was 60, is 30"),
    (StreamSettings(timezone="UTC", watermark_minutes=45), "watermark_minutes was 30, is 45"),
    (StreamSettings(timezone="Asia/Colombo"), "timezone was UTC, is Asia/Colombo")])
def test_other_settings_are_refused_before_anything_is_counted(spark, tmp_path, changed, told):
    topic = Topic(tmp_path)
    topic.send("00:10", "00:40")
    once(spark, tmp_path, topic)
    topic.send("00:50")
    with pytest.raises(ValueError, match=told):
        once(spark, tmp_path, topic, changed)
    once(spark, tmp_path, topic)
    assert used(jobs.zone_windows_view(spark, f"{tmp_path}/m")) == {0: 3.0}


def test_an_older_checkpoint_without_a_record_is_judged_by_its_state(spark, tmp_path):
    topic = Topic(tmp_path)
    topic.send("00:10", "00:40")
    once(spark, tmp_path, topic, dedupe=True, recorded=False)
    assert checkpoints.record(spark, f"{tmp_path}/c") is None
    before = jobs.Life(f"{tmp_path}/c")(spark)
    for changed in (StreamSettings(timezone="UTC", window_minutes=30), StreamSettings(timezone="Asia/Colombo"),
                    StreamSettings(timezone="UTC", watermark_minutes=45)):
        with pytest.raises(ValueError):
            checkpoints.admit(spark, f"{tmp_path}/c", changed)
    known = checkpoints.admit(spark, f"{tmp_path}/c", UTC)
    assert known["window_minutes"] == 60 and jobs.Life(f"{tmp_path}/c")(spark) == before


def test_what_a_state_tells(spark, tmp_path):
    topic = Topic(tmp_path)
    topic.send("00:10", "00:40", "01:05")
    once(spark, tmp_path, topic, dedupe=True)
    place = f"{tmp_path}/c"
    assert rows(checkpoints.operators(spark, place).select("operator"), "operator") == [("dedupeWithinWatermark",), ("stateStoreSave",)]
    found = checkpoints.fitness(spark, place, UTC, ["stateStoreSave", "dedupeWithinWatermark"])
    assert found.count() == 4 and found.where("not fits").count() == 0
    other = checkpoints.fitness(spark, place, StreamSettings(timezone="Asia/Colombo", window_minutes=120), ["stateStoreSave"])
    assert {r.check: (r.found, r.expected, r.fits) for r in other.collect()} == {
        "steps": ("stateStoreSave, dedupeWithinWatermark", "stateStoreSave", False), "window_minutes": ("60", "120", False),
        "window start": ("0 to 60", "90", False), "watermark_minutes": ("30", "30", True)}
    held = {r.operator: r.rows for r in checkpoints.state_rows(spark, place).collect()}
    assert held == {"stateStoreSave": 2, "dedupeWithinWatermark": 3}   # kept until half an hour after each, the watermark is at 00:35


def test_an_empty_state_has_nothing_to_tell(spark, tmp_path):
    topic = Topic(tmp_path)
    topic.send("00:10")
    query = once(spark, tmp_path, topic)
    assert query.exception() is None
    held = checkpoints.state(spark, f"{tmp_path}/c", 0).where(F.lit(False))
    assert checkpoints._told(held.select(F.lit(1).alias("v")), "x", 1).count() == 0


def test_a_copied_checkpoint_keeps_its_name(spark, tmp_path):
    topic = Topic(tmp_path)
    topic.send("00:10")
    once(spark, tmp_path, topic)
    shutil.copytree(f"{tmp_path}/c", f"{tmp_path}/copy", copy_function=shutil.copy)     # with new file times
    assert jobs.Life(f"{tmp_path}/copy")(spark) == jobs.Life(f"{tmp_path}/c")(spark)
    topic.send("00:20")
    once(spark, tmp_path, topic, checkpoint="copy")
    assert used(jobs.zone_windows_view(spark, f"{tmp_path}/m")) == {0: 2.0}
