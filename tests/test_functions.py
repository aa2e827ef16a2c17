from datetime import date, datetime
from decimal import Decimal
from fractions import Fraction
import hashlib

import pytest
from hypothesis import given, settings as hyp, strategies as st
from pyspark.sql import functions as F

from meterflow import settings
from meterflow.functions import amounts, hashing, times
from tests.helpers import at, dec, literal


def test_share_zero_use_and_above_hundred(spark):
    r = literal(spark, amounts.share_pct(dec("5"), dec("0")), amounts.share_pct(dec("30"), dec("12")),
                amounts.share_pct(dec("1"), dec("0"), 1, empty=None))
    assert (r.c0, r.c1, r.c2) == (Decimal("0.00"), Decimal("250.00"), None)


@hyp(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**9), st.integers(1, 10**9)), min_size=5, max_size=20))
def test_share_is_half_up_on_the_exact_quotient(pairs):
    from tests.session import session

    spark = session()
    data = [(i, Decimal(a).scaleb(-4), Decimal(b).scaleb(-4)) for i, (a, b) in enumerate(pairs)]
    df = spark.createDataFrame(data, "i int, a decimal(18,4), b decimal(18,4)")
    got = {r.i: r.p for r in df.select("i", amounts.share_pct(F.col("a"), F.col("b")).alias("p")).collect()}
    for i, (a, b) in enumerate(pairs):
        expected = (Fraction(10_000 * a, b) + Fraction(1, 2)).__floor__()
        assert got[i] == Decimal(expected).scaleb(-2)


def test_money_rounds_half_up(spark):
    r = literal(spark, amounts.gross_amount(dec("2.675"), dec("1", "decimal(9,2)")),
                amounts.gross_amount(dec("0.125"), dec("1", "decimal(9,2)")))
    assert (r.c0, r.c1) == (Decimal("2.68"), Decimal("0.13"))


def test_mean_power(spark):
    def kw(kwh, minutes, meters):
        return amounts.mean_kw_per_meter(dec(kwh), minutes, F.lit(meters))

    r = literal(spark, kw("12", 60, 12), kw("12", 30, 12), kw("12", 60, 0), kw("12", 0, 12))
    assert tuple(r) == (1.0, 2.0, 0.0, 0.0)


def test_average_load_from_bounds(spark):
    start, end = F.lit(at("2026-01-01T00:00")), F.lit(at("2026-01-01T00:30"))
    r = literal(spark, amounts.avg_load_kw(dec("6.2345"), start.cast("timestamp_ntz"), end.cast("timestamp_ntz")),
                amounts.avg_load_kw(dec("6"), start.cast("timestamp_ntz"), start.cast("timestamp_ntz")))
    assert (r.c0, r.c1) == (Decimal("12.469"), None)


def test_energy_units_are_exact(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(1.23456,), (0.0,)], "kwh double")
    assert df.agg(amounts.sum_kwh("kwh")).first()[0] == Decimal("2.2346")
    tiny = spark.range(10_000).select(F.lit(0.00004).alias("kwh"))
    assert tiny.agg(amounts.sum_kwh("kwh")).first()[0] == Decimal("0.4000"), "rounded once, after the sum"
    large = spark.createDataFrame([(1e6,)] * 5 + [(-0.0,)], "kwh double")
    assert large.agg(amounts.sum_kwh("kwh")).first()[0] == Decimal("5000000.0000")


def test_bands(spark):
    steps = ((30, "orange"), (60, "red"))
    r = literal(spark, *[amounts.band(F.lit(v), *steps, base="green") for v in (29, 30, 59, 60)])
    assert tuple(r) == ("green", "orange", "orange", "red")


def test_strict_bool(spark):
    r = literal(spark, *[amounts.strict_bool(F.lit(t)) for t in ("FALSE", " True ", "true", "yes", "1")])
    assert tuple(r) == (False, True, True, False, False)


def test_difference(spark):
    r = literal(spark, amounts.difference_pct(dec("100"), dec("99.3")), amounts.difference_pct(dec("0"), dec("4")),
                amounts.difference_pct(dec("10"), F.lit(None).cast("decimal(18,4)")),
                amounts.difference_pct(dec("100"), dec("125.25")))
    assert tuple(r) == (Decimal("0.7"), Decimal("0.0"), None, Decimal("-25.3"))


# -- time --------------------------------------------------------------------

def test_day_edge(spark):
    records = ["2026-01-01T02:00:00+05:30", "2026-01-01T00:02:00+05:30"]
    utc = [times.instant_to_utc(F.lit(t).cast("timestamp")) for t in records]
    r = literal(spark, *[times.local_day(u, zone) for zone in ("Asia/Colombo", "UTC") for u in utc])
    assert list(r) == [date(2026, 1, 1)] * 2 + [date(2025, 12, 31)] * 2


@pytest.mark.parametrize("zone", ["UTC", "Asia/Colombo", "Europe/Berlin", "America/New_York",
                                  "Asia/Kathmandu"])
def test_zone_conversion_equals_the_general_function(spark, zone):
    hours = spark.sql("select timestamp_ntz'1994-01-01' + make_dt_interval(0, id * 331) as t from range(1400)")
    local = hours.withColumn("l", times.to_local("t", zone)).withColumn(
        "g", F.convert_timezone(F.lit("UTC"), F.lit(zone), "t"))
    assert local.where("l <> g").count() == 0
    back = local.withColumn("u", times.to_utc("l", zone)).withColumn(
        "h", F.convert_timezone(F.lit(zone), F.lit("UTC"), "l"))
    assert back.where("u <> h").count() == 0


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York", "Asia/Colombo"])
def test_instants_do_not_depend_on_the_session_zone(spark, session_zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        noon = F.lit("2026-03-08 07:30:00").cast("timestamp_ntz")
        text = F.lit("2026-01-01T02:00:00+05:30").cast("timestamp")
        r = literal(spark, times.instant_to_utc(times.utc_to_instant(noon)), times.instant_to_utc(text),
                    times.offset_text(noon, "Asia/Colombo"))
        assert (r.c0, r.c1) == (datetime(2026, 3, 8, 7, 30), datetime(2025, 12, 31, 20, 30))
        assert r.c2 == "2026-03-08 13:00:00+05:30"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_negative_offset_text(spark):
    noon = F.lit("2026-01-08 12:00:00").cast("timestamp_ntz")
    assert literal(spark, times.offset_text(noon, "America/St_Johns")).c0 == "2026-01-08 08:30:00-03:30"


def test_window_shift():
    assert [times.window_shift_minutes("Asia/Colombo", n) for n in (60, 30, 15)] == [30, 0, 0]
    assert times.window_shift_minutes("UTC", 60) == 0
    with pytest.raises(ValueError):
        times.window_shift_minutes("Europe/Berlin", 60)


def test_parse_day(spark):
    texts = ["20260127", "2026-01-27", "2026-0127", "2026/01/27", "20261327", "day", "", "202601270"]
    r = literal(spark, *[times.parse_day(F.lit(t)) for t in texts])
    assert list(r) == [date(2026, 1, 27)] * 3 + [None] * 5


def test_hour_range_is_half_open(spark):
    hours = [F.lit(f"2026-01-01 {h:02d}:00:00").cast("timestamp_ntz") for h in (8, 9, 15, 16)]
    assert list(literal(spark, *[times.hour_in(h, 9, 16) for h in hours])) == [False, True, True, False]


# -- draws -------------------------------------------------------------------

def test_stable_fraction_golden(spark):
    r = literal(spark, hashing.stable_fraction("tier", F.lit("H-101")))
    assert r.c0 == 0.09191422490403056


@hyp(max_examples=10, deadline=None)
@given(st.lists(st.text(min_size=1, max_size=12), min_size=1, max_size=8))
def test_stable_fraction_is_the_md5_prefix(texts):
    from tests.session import session

    df = session().createDataFrame([(t,) for t in texts], "t string")
    for t, f in df.select("t", hashing.stable_fraction("solar", F.col("t"))).collect():
        digest = hashlib.md5(f"solar|{t}".encode()).hexdigest()
        assert f == int(digest[:8], 16) / 2**32 and 0 <= f < 1


def test_weights_are_normalised_and_the_last_takes_the_rest(spark):
    weights = {"b": 2.0, "a": 1.0, "c": 1.0}
    points = [0.0, 0.2499, 0.25, 0.7499, 0.75, 0.9999999]
    r = literal(spark, *[hashing.weighted_choice(F.lit(p), weights) for p in points])
    assert list(r) == ["a", "a", "b", "b", "c", "c"]
    assert literal(spark, hashing.weighted_choice(F.lit(0.5), {"only": 3.0})).c0 == "only"


# -- settings ----------------------------------------------------------------

def test_settings_are_checked():
    settings.StreamSettings()
    with pytest.raises(ValueError, match="shorter"):
        settings.StreamSettings(watermark_minutes=5, max_lateness_minutes=1)
    with pytest.raises(ValueError, match="late"):
        settings.StreamSettings(max_lateness_minutes=31)
    with pytest.raises(ValueError):
        settings.StreamSettings(window_minutes=0)
    with pytest.raises(ValueError, match="meter"):
        settings.StreamSettings(zones={"a": 0})
    with pytest.raises(ValueError, match="domestic-9"):
        settings.check_tiers({"domestic-1": 1.0}, {"domestic-9": 1.0})
    with pytest.raises(ValueError, match="not supported"):
        settings.BillingTerms(net_metering="export_paid")
