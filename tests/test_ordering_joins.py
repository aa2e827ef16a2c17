import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from meterflow.operators import joins, keyed, ledger, ordering, sampling
from tests.helpers import at, plan, rows

START = datetime(2026, 1, 1)


def arrivals(spark, seed, n=400):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        source = "hot" if rng.random() < 0.6 else rng.choice("abc")
        data.append((source, i, START + timedelta(seconds=rng.randrange(20000)),
                     START + timedelta(seconds=rng.randrange(20000))))
    return data, spark.createDataFrame(data, "source string, id int, arrived timestamp_ntz, ts timestamp_ntz")


@pytest.mark.parametrize("seed, bucket", [(1, "minute"), (3, "hour"), (16, "day")])
def test_out_of_order_equals_brute_force(spark, seed, bucket):
    data, df = arrivals(spark, seed)
    got = {r.source: (r.events, r.out_of_order)
           for r in ordering.out_of_order(df.repartition(5), "source", ["arrived", "id"], "ts",
                                          F.date_trunc(bucket, "arrived")).collect()}
    for source in {d[0] for d in data}:
        mine = sorted((d for d in data if d[0] == source), key=lambda d: (d[2], d[1]))
        lower = sum(b[3] < a[3] for a, b in zip(mine, mine[1:]))
        assert got[source] == (len(mine), lower)


@pytest.mark.parametrize("limit", [1, 60, 900])
def test_gaps_equal_brute_force(spark, limit):
    data, df = arrivals(spark, limit, 300)
    wide = df.withColumn("arrived", F.col("arrived") + F.make_dt_interval(days=F.col("id") % 3))
    got = {(r.source, r.gap_start, r.gap_end) for r in ordering.gaps(wide, "arrived", limit, ["source"]).collect()}
    expected = set()
    for source in {d[0] for d in data}:
        times = sorted({d[2] + timedelta(days=d[1] % 3) for d in data if d[0] == source})
        expected |= {(source, a, b) for a, b in zip(times, times[1:]) if (b - a).total_seconds() > limit}
    assert got == expected
    together = ordering.gaps(wide, "arrived", limit)
    times = sorted({d[2] + timedelta(days=d[1] % 3) for d in data})
    assert together.count() == sum((b - a).total_seconds() > limit for a, b in zip(times, times[1:]))


def test_trailing_counts_equal_brute_force(spark):
    data, df = arrivals(spark, 5, 120)
    got = {(r.source, r.at_minute): r.in_window for r in
           ordering.trailing_counts(df, "arrived", ["source"], 5).collect()}
    minute = [(d[0], d[2].replace(second=0)) for d in data]
    for (source, m), n in got.items():
        assert n == sum(s == source and m - timedelta(minutes=4) <= t <= m for s, t in minute)
    assert sum(got.values()) == 5 * len(data)


def test_latest_per_group_cuts_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    latest = ordering.latest_per_group(df, ["g"], [F.col("v").desc()])
    assert rows(latest.select("g", "v"), "g") == [(0, 99), (1, 97), (2, 98)]
    p = plan(latest)
    assert p.count("WindowGroupLimit") == 2


def test_newest_then_ascending(spark):
    df = spark.range(20).toDF("d")
    assert [r.d for r in ordering.newest_then_ascending(df, "d", 3).collect()] == [17, 18, 19]


# -- keyed tables ------------------------------------------------------------

def test_merge_incoming_wins(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert rows(keyed.merge_keyed(old, new, ["k"]), "k") == [(1, "a"), (2, "B"), (3, "C")]


def test_replacing_days_drops_stale_rows(spark):
    old = spark.createDataFrame([("d1", 1), ("d1", 2), ("d2", 3)], "sim_day string, h int")
    new = spark.createDataFrame([("d1", 1)], "sim_day string, h int")
    assert sorted(rows(keyed.replace_days(old, new))) == [("d1", 1), ("d2", 3)]


def test_constraints(spark):
    df = spark.createDataFrame([(1, "INFO"), (1, "LOUD"), (None, None)], "k int, level string")
    got = {(r["check"], r["column"]): r.violations for r in keyed.constraint_findings(
        df, ["k"], ["k", "level"], {"level": ["INFO", "WARN"]}).collect()}
    assert got == {("not_null", "k"): 1, ("not_null", "level"): 1, ("domain", "level"): 1, ("primary_key", "k"): 1}


# -- ledger ------------------------------------------------------------------

def _event(run, kind, time, component="billing", status=None, written=None, notes=None):
    return (run, component, None, at(time), kind, status, written, notes)


EVENT = ("run_id string, component string, sim_day date, at timestamp_ntz, kind string, status string, "
         "rows_written bigint, notes string")


def test_a_later_start_fails_the_run_before_it(spark):
    events = spark.createDataFrame([
        _event("A", "start", "2026-01-01T01:00", notes="billing 20260101"), _event("B", "start", "2026-01-03T01:00"),
        _event("B", "finish", "2026-01-03T02:00", status="SUCCESS", written=40),
        _event("S", "start", "2026-01-01T00:00", "speed"),
        _event("C", "start", "2026-01-03T03:00", notes="again"),
        _event("D", "start", "2026-01-03T03:30"),
        _event("C", "finish", "2026-01-03T04:00", status="SUCCESS", written=1),
    ], EVENT)
    folded = ledger.fold(events)
    assert [r.run_id for r in ledger.superseded_by(folded, "B").collect()] == ["A"]
    runs = {r.run_id: r for r in folded.collect()}
    assert (runs["A"].status, runs["A"].finished_at) == ("FAILED", at("2026-01-03T01:00"))
    assert runs["A"].notes == "billing 20260101 | did not shut down cleanly; superseded by B"
    assert (runs["B"].status, runs["B"].rows_written, runs["B"].notes) == ("SUCCESS", 40, None)
    assert (runs["S"].status, runs["S"].finished_at) == ("RUNNING", None)
    assert (runs["C"].status, runs["C"].finished_at) == ("SUCCESS", at("2026-01-03T04:00"))
    assert runs["C"].notes == "again | did not shut down cleanly; superseded by D"
    assert runs["D"].status == "RUNNING"


def test_fold_equals_a_sequential_ledger(spark):
    rng = random.Random(4)
    events, state = [], {}
    timeline = []
    for i in range(120):
        begin = START + timedelta(minutes=rng.randrange(60 * 24 * 6), seconds=i)
        timeline.append((begin, "start", f"r{i:03d}", rng.choice("xy"), None))
        if rng.random() < 0.6:
            end = begin + timedelta(minutes=rng.randrange(1, 600), seconds=0.5)
            timeline.append((end, "finish", f"r{i:03d}", timeline[-1][3], rng.choice(["SUCCESS", "FAILED"])))
    for time, kind, run, component, status in sorted(timeline):
        events.append((run, component, None, time, kind, status, None, None))
        if kind == "finish":
            state[run].update(status=status, end=time)
            continue
        for other in state.values():
            if other["component"] == component and other["status"] == "RUNNING":
                other.update(status="FAILED", end=time, note=f"did not shut down cleanly; superseded by {run}")
        state[run] = {"component": component, "status": "RUNNING", "end": None, "note": None}
    for r in ledger.fold(spark.createDataFrame(events, EVENT)).collect():
        mine = state[r.run_id]
        assert (r.status, r.finished_at, r.notes) == (mine["status"], mine["end"], mine["note"]), r.run_id


def test_last_success_ignores_failures(spark):
    events = spark.createDataFrame([
        _event("A", "start", "2026-01-01T01:00"), _event("A", "finish", "2026-01-01T01:01", status="SUCCESS"),
        _event("B", "start", "2026-01-02T01:00"), _event("B", "finish", "2026-01-02T01:05", status="FAILED"),
    ], EVENT)
    runs = ledger.fold(events)
    assert rows(ledger.last_success_seconds(runs)) == [("billing", 60)]
    now = F.lit("2026-01-02 01:10:00").cast("timestamp_ntz")
    assert rows(ledger.failed_in_last(runs, 15, now)) == [("billing", 1)]
    assert rows(ledger.failed_in_last(runs, 5, now)) == [("billing", 0)]
    assert rows(ledger.newest_per_day(runs.withColumn("sim_day", F.lit("d")), "billing").select("run_id", "times_run")) \
        == [("B", 2)]


# -- sampling ----------------------------------------------------------------

# Zones with their number of households and share with panels.
ZONES = [("Colombo-North", 12, 0.75), ("Colombo-South", 10, 0.60), ("Gampaha", 9, 0.45), ("Kandy", 9, 0.30)]


def grid(spark):
    people, number = [], 101
    for zone, count, share in ZONES:
        people += [(zone, f"H-{n}", share) for n in range(number, number + count)]
        number += count
    return spark.createDataFrame(people, "grid_zone string, household_id string, share double")


@pytest.mark.parametrize("bits", [1, 4, 12])
def test_quota_is_exact_and_by_hash_rank(spark, bits):
    import hashlib

    chosen = sampling.quota_sample(grid(spark), "grid_zone", "household_id", "share", bucket_bits=bits)
    got = {}
    for r in chosen.where("chosen").collect():
        got.setdefault(r.grid_zone, set()).add(r.household_id)
    assert [len(got[z]) for z, _, _ in ZONES] == [9, 6, 4, 3]
    for zone, people in got.items():
        members = [r.household_id for r in grid(spark).where(F.col("grid_zone") == zone).collect()]
        ranked = sorted(members, key=lambda h: hashlib.md5(f"solar|{h}".encode()).hexdigest()[:8])
        assert people == set(ranked[:len(people)])


def test_published_rates_and_tiers(spark):
    from datetime import date

    days = (F.lit("2026-01-02"), F.lit("2026-01-21"))
    table = sampling.rate_table(grid(spark), *days)
    one = {(r.household_id, r.sim_day): r for r in table.where("household_id in ('H-101', 'H-105')").collect()}
    h101 = one["H-101", date(2026, 1, 21)]
    assert float(one["H-101", date(2026, 1, 2)].tariff_rate) == 30.73
    assert (float(h101.tariff_rate), h101.billing_tier, h101.subsidy_flag) == (30.85, "domestic-1", False)
    h105 = one["H-105", date(2026, 1, 21)]
    assert (float(h105.tariff_rate), h105.billing_tier, h105.subsidy_flag) == (46.25, "domestic-2", True)
    day = table.where("sim_day = date'2026-01-21'")
    assert rows(day.groupBy("billing_tier").count(), "billing_tier") == [
        ("domestic-1", 12), ("domestic-2", 19), ("domestic-3", 9)]
    assert day.where("subsidy_flag").count() == 12
    assert table.count() == 40 * 20
    base = F.when(F.col("billing_tier") == "domestic-1", 30).when(F.col("billing_tier") == "domestic-2", 45).otherwise(62)
    assert table.where(F.abs(F.col("tariff_rate") / base - 1) > 0.0501).count() == 0
