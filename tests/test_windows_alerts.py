from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from meterflow.operators import alerts, audit, energy
from meterflow.plans import reports
from meterflow.settings import AlertThresholds
from tests.helpers import at, readings, rows

TZ = "Asia/Colombo"
WINDOW = ("window_start timestamp_ntz, window_end timestamp_ntz, grid_zone string, "
          "total_consumption_kwh decimal(18,4), total_solar_kwh decimal(18,4), "
          "renewable_pct decimal(18,2), active_meters bigint, updated_at timestamp_ntz")


def window(spark, local_hour=12, share="50", used="12", meters=12, zone="Kandy", minutes=60):
    from datetime import timedelta

    start = at(f"2026-01-02T{local_hour:02d}:00") - timedelta(minutes=330)
    return spark.createDataFrame([(start, start + timedelta(minutes=minutes), zone, Decimal(used), Decimal("1"),
                                   Decimal(share), meters, start)], WINDOW)


def fired(df, **limits):
    return sorted(r.rule for r in alerts.evaluate(df, TZ, AlertThresholds(**limits)).collect())


@pytest.mark.parametrize("hour, share, expected", [
    (12, "10", True), (12, "25", False), (2, "0", False), (6, "1", False), (17, "1", False),
    (16, "1", False), (9, "1", True), (15, "14.99", True), (15, "15", False)])
def test_low_renewable_only_near_noon(spark, hour, share, expected):
    assert fired(window(spark, hour, share)) == ([alerts.LOW_RENEWABLE] if expected else [])


def test_overload_is_strict_and_per_meter(spark):
    assert fired(window(spark, used="26.4")) == []              # exactly 2.2 kW per meter
    assert fired(window(spark, used="26.5")) == [alerts.ZONE_OVERLOAD]
    assert fired(window(spark, used="500", meters=0)) == []
    assert fired(window(spark, used=str(1.25 * 1.5 * 10), meters=10)) == []


def test_both_rules_and_their_texts(spark):
    found = {r.rule: r for r in alerts.evaluate(window(spark, share="10.04", used="30"), TZ).collect()}
    low, high = found[alerts.LOW_RENEWABLE], found[alerts.ZONE_OVERLOAD]
    assert low.message == "Low renewable contribution, Kandy: 10.0% (floor 15%) at 2026-01-02 12:00 simulated"
    assert high.message == "Zone load high, Kandy: 2.50 kW/meter across 12 meters (ceiling 2.20)"
    assert {low.level, high.level} == {"WARN"}


def test_known_conditions_are_not_raised_again(spark):
    raised = alerts.evaluate(window(spark, share="1"), TZ)
    assert alerts.not_yet_raised(raised, raised).count() == 0
    other = alerts.evaluate(window(spark, share="1", zone="Gampaha"), TZ)
    assert alerts.not_yet_raised(raised, other).count() == 1


def test_alert_lists(spark):
    log = alerts.evaluate(window(spark, share="1", used="99").unionByName(window(spark, 13, "2", zone="Gampaha")), TZ)
    assert rows(alerts.counts(log), "rule") == [(alerts.LOW_RENEWABLE, "WARN", 2), (alerts.ZONE_OVERLOAD, "WARN", 1)]
    assert alerts.recent(log, 2).count() == 2
    assert alerts.recent(log, 9, rule=alerts.ZONE_OVERLOAD).count() == 1
    assert [r.grid_zone for r in alerts.recent(log, 9, grid_zone="Gampaha").collect()] == ["Gampaha"]
    newest = {r.rule: r.latest_message for r in alerts.latest_message(log).collect()}
    assert "Gampaha" in newest[alerts.LOW_RENEWABLE]


# -- windows -----------------------------------------------------------------

def test_windows_on_the_local_clock(spark):
    df = readings(spark, [(1, "a", 1, 0, "2026-01-01T00:29:59"), (2, "a", 1, 1, "2026-01-01T00:30:00"),
                          (2, "a", 1, 1, "2026-01-01T01:29:59")])
    got = rows(energy.zone_windows(df, TZ).select("window_start", "total_consumption_kwh", "active_meters"),
               "window_start")
    assert got == [(at("2025-12-31T23:30"), Decimal("1.0000"), 1), (at("2026-01-01T00:30"), Decimal("2.0000"), 1)]


def test_zero_use_and_share_over_hundred(spark):
    df = readings(spark, [(1, "dark", 0, 0, "2026-01-01T00:00"), (2, "sunny", 2, 5, "2026-01-01T00:00")])
    shares = dict(rows(energy.zone_windows(df, "UTC").select("grid_zone", "renewable_pct")))
    assert shares == {"dark": Decimal("0.00"), "sunny": Decimal("250.00")}


def test_approximate_meter_count_is_close(spark):
    df = readings(spark, [(i, "a", 1, 0, "2026-01-01T00:00") for i in range(600)])
    exact = energy.aggregate_energy(df, ["grid_zone"]).first().active_meters
    approx = energy.aggregate_energy(df, ["grid_zone"], "approx").first().active_meters
    assert exact == 600 and abs(approx - 600) < 90
    with pytest.raises(ValueError):
        energy.aggregate_energy(df, ["grid_zone"], "some")


def _metrics(spark, *items):
    return readings(spark, [(1, zone, used, 1, time) for zone, used, time in items])


def test_latest_complete_and_open_windows(spark):
    windows = energy.zone_windows(_metrics(
        spark, ("a", 1, "2026-01-01T01:00"), ("a", 2, "2026-01-01T02:00"), ("a", 3, "2026-01-01T03:00"),
        ("b", 4, "2026-01-01T01:00"), ("c", 5, "2026-01-01T03:00")), "UTC")
    complete = rows(reports.zones(windows).select("grid_zone", "total_consumption_kwh"), "grid_zone")
    assert complete == [("a", Decimal(2)), ("b", Decimal(4))]
    newest = rows(reports.zones(windows, include_open=True).select("grid_zone", "total_consumption_kwh"), "grid_zone")
    assert newest == [("a", Decimal(3)), ("b", Decimal(4)), ("c", Decimal(5))]
    assert audit.latest_two_ways(windows, reports.zones(windows)).count() == 0
    assert audit.latest_two_ways(windows, reports.zones(windows, include_open=True)).count() > 0


def test_one_window_is_never_complete(spark):
    windows = energy.zone_windows(_metrics(spark, ("a", 1, "2026-01-01T01:00"), ("b", 2, "2026-01-01T01:30")), "UTC")
    assert reports.zones(windows).count() == 0
    assert reports.zones(windows, include_open=True).count() == 2
    assert reports.zones_total(windows).first().zone_count == 0


def test_health_with_and_without_windows(spark):
    windows = energy.zone_windows(_metrics(spark, ("a", 1, "2026-01-01T01:00")), "UTC")
    zones = spark.createDataFrame([("a", 1), ("b", 1)], "grid_zone string, meters int")

    def state(df, now):
        return reports.health(df, zones, F.lit(now).cast("timestamp_ntz")).first()

    fresh, stale = state(windows, "2026-01-01 01:00:30"), state(windows, "2026-01-01 01:00:31")
    assert (fresh.status, fresh.seconds_since_last_write, stale.status) == ("ok", Decimal("30.0"), "degraded")
    empty = state(windows.limit(0), "2026-01-01 01:00:00")
    assert (empty.data_fresh, empty.windows_stored, empty.newest_window_start) == (False, 0, None)
    assert empty.zones_configured == 2


def test_history_limits(spark):
    windows = energy.zone_windows(_metrics(spark, *[("a", i, f"2026-01-01T{i:02d}:00") for i in range(5)]), "UTC")
    got = [r.window_start.hour for r in reports.zone_history(windows, "a", 3).collect()]
    assert got == [4, 3, 2]
    assert reports.zone_history(windows, "a", 5000).count() == 5
    for limit in (0, -1):
        with pytest.raises(ValueError):
            reports.zone_history(windows, "a", limit)


def test_window_checks_find_bad_rows(spark):
    good = window(spark, share="8.33")
    bad = window(spark, share="50", minutes=30, meters=50)
    limit = F.lit(40).cast("bigint")
    got = rows(audit.window_checks(good.unionByName(bad), limit).select("check", "windows", "failed", "ok"), "check")
    assert got == [("active_meters", 2, 1, False), ("renewable_pct", 2, 1, False), ("window_length", 2, 1, False)]


def test_closed_days(spark):
    df = readings(spark, [(1, "a", 1, 0, "2026-01-01T10:00"), (1, "a", 1, 0, "2026-01-02T00:29")])
    def closed(extra):
        full = df.unionByName(readings(spark, [(1, "a", 1, 0, extra)]))
        return [(str(r.sim_day), r.is_closed) for r in energy.closed_days(full, "UTC", 30).orderBy("sim_day").collect()]

    assert closed("2026-01-02T00:29:59")[0] == ("2026-01-01", False)
    assert closed("2026-01-02T00:30:00")[0] == ("2026-01-01", True)


def test_layers_side_by_side(spark):
    from meterflow.operators import billing  # noqa: F401
    bills = spark.sql("select date'2026-01-01' as sim_day, z as grid_zone, cast(100 as decimal(18,4)) as total_consumption_kwh "
                      "from values ('a'), ('b') t(z)")
    windows = spark.sql("select date'2026-01-01' as sim_day, 'a' as grid_zone, cast(99.3 as decimal(18,4)) as total_consumption_kwh")
    got = rows(audit.layer_agreement(bills, windows).select("grid_zone", "windows", "difference_pct", "verdict"), "grid_zone")
    assert got == [("a", 1, Decimal("0.7"), "differs"), ("b", 0, None, "no windows")]
