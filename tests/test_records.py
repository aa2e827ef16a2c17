import json
from collections import Counter

from meterflow.operators import dedupe
from meterflow.sources import records
from tests.helpers import at, plan, readings, rows

GOOD = {"meter_id": "M-1", "household_id": "H-1", "grid_zone": "Kandy",
        "power_consumption_kwh": 1.5, "solar_generation_kwh": 0.25,
        "timestamp": "2026-01-01T02:00:00+05:30"}


def payload(**changes):
    return json.dumps({k: v for k, v in {**GOOD, **changes}.items() if v != "drop"})


BROKEN = {
    "not json": "payload is not a JSON object",
    "[1, 2]": "payload is not a JSON object",
    payload(power_consumption_kwh="abc"): "power_consumption_kwh is not a number",
    payload(power_consumption_kwh="1.5"): "power_consumption_kwh is not a number",
    json.dumps({"meter_id": "M-1"}): "missing household_id",
    json.dumps({"grid_zone": "Kandy"}): "missing meter_id",
    payload(timestamp="bad"): "timestamp is not ISO-8601",
    payload(solar_generation_kwh=-0.5): "solar_generation_kwh is negative",
    payload(solar_generation_kwh="drop"): "missing solar_generation_kwh",
    payload(grid_zone=None): "missing grid_zone",
    payload(power_consumption_kwh=float("nan")): "power_consumption_kwh is not a number",
    "{}": "missing meter_id",
}


def frame(spark, texts):
    return spark.createDataFrame([(None if t is None else bytearray(t.encode()),) for t in texts],
                                 "value binary")


def test_good_records_are_typed_and_dated_locally(spark):
    df = records.parse_readings(frame(spark, [payload()]), "Asia/Colombo")
    r = df.first()
    assert (r.meter_id, r.power_consumption_kwh, r.timestamp) == ("M-1", 1.5, at("2025-12-31T20:30"))
    assert str(r.sim_day) == "2026-01-01" and r.ingested_at is not None


def test_every_broken_record_is_refused_with_its_reason(spark):
    texts = [*BROKEN, payload(), None]
    df = frame(spark, texts)
    assert records.parse_readings(df, "UTC").count() == 1
    got = Counter(r.reason for r in records.quarantine(df).collect())
    expected = Counter(BROKEN.values())
    expected["payload is not a JSON object"] += 1          # the null value
    assert got == expected


def test_json_is_parsed_once_per_record(spark):
    p = plan(records.parse_readings(frame(spark, [payload()]), "UTC"))
    assert p.count("from_json") <= 1 + p.count("Generate explode")


def test_roundtrip_through_json(spark):
    df = readings(spark, [(1, "Kandy", 1.2345, 0.5, "2026-01-01T02:00:00.123456"),
                          (2, "Kandy", 0, 7, "2026-01-01T03:00:00")])
    text = df.select(records.to_records(df).alias("value"))
    back = records.parse_readings(text, "UTC")
    keys = ["meter_id", "power_consumption_kwh", "solar_generation_kwh", "timestamp"]
    assert rows(back.select(*keys), "meter_id") == rows(df.select(*keys), "meter_id")


# -- replays -----------------------------------------------------------------

def test_replayed_readings_keep_the_earliest_arrival(spark):
    first = [(1, "a", 1, 0, "2026-01-01T00:00", "2026-01-01T00:05"),
             (2, "a", 2, 0, "2026-01-01T00:00", "2026-01-01T00:06")]
    again = [(1, "a", 1, 0, "2026-01-01T00:00", "2026-01-01T00:20")] * 3
    store = dedupe.with_replay(readings(spark, first), readings(spark, again))
    kept = dedupe.dedupe_readings(store)
    assert rows(kept.select("meter_id", "ingested_at"), "meter_id") == [
        ("M-1", at("2026-01-01T00:05")), ("M-2", at("2026-01-01T00:06"))]
    assert rows(dedupe.duplicate_stats(store)) == [(5, 2, 3)]


def test_conflicting_copies_have_one_fixed_survivor(spark):
    copies = [(1, "a", v, 0, "2026-01-01T00:00") for v in (3, 1, 2)]
    for order in (copies, copies[::-1]):
        kept = dedupe.dedupe_readings(readings(spark, order).repartition(3))
        assert [r.power_consumption_kwh for r in kept.collect()] == [1.0]


def test_stats_of_an_empty_store(spark):
    assert rows(dedupe.duplicate_stats(readings(spark, []))) == [(0, 0, 0)]


def test_copies_are_cut_before_the_shuffle(spark, sf_dir):
    from meterflow.sources import standin

    p = plan(dedupe.dedupe_readings(standin.readings(spark, sf_dir, resent=True)))
    assert "WindowGroupLimit" in p and "Partial" in p
    assert p.index("Final") < p.index("Exchange hashpartitioning") < p.index("Partial")
