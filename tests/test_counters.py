"""Counter rates against a plain version that looks at each range's own samples."""

import random
from datetime import datetime, timedelta

import pytest

from meterflow.operators import counters
from tests.helpers import rows

START = datetime(2026, 1, 1)
SAMPLES = "job string, at timestamp_ntz, total long"


def plain(samples, width, step, counter=True):
    """(job, at, samples, resets, increase) of every range with two samples."""
    out = []
    for job in {s[0] for s in samples}:
        highest = {}
        for j, at, v in samples:
            if j == job:
                highest[at] = max(v, highest.get(at, v))
        series = sorted(((at - datetime(1970, 1, 1)) / timedelta(microseconds=1), float(v)) for at, v in highest.items())
        last = int(series[-1][0] // (step * 1e6)) + width // step + 2
        for k in range(int(series[0][0] // (step * 1e6)), last):
            end = k * step * 1e6
            inside = [s for s in series if end - width * 1e6 < s[0] <= end]
            if len(inside) < 2:
                continue
            rise, resets = 0.0, 0
            for (_, a), (_, b) in zip(inside, inside[1:]):
                if counter and b < a:
                    rise, resets = rise + b, resets + 1
                else:
                    rise += b - a
            span = (inside[-1][0] - inside[0][0]) / 1e6
            gap = span / (len(inside) - 1)
            front, back = (inside[0][0] - (end - width * 1e6)) / 1e6, (end - inside[-1][0]) / 1e6
            front = gap / 2 if front >= gap * 1.1 else front
            back = gap / 2 if back >= gap * 1.1 else back
            if counter and rise > 0:
                front = min(front, span * (inside[0][1] / rise))
            out.append((job, datetime(1970, 1, 1) + timedelta(microseconds=end), len(inside), resets, rise * ((span + front + back) / span)))
    return sorted(out)


@pytest.mark.parametrize("counter", [True, False])
def test_random_counters_with_restarts(spark, counter):
    rng, samples = random.Random(5), []
    for job in "abc":
        at, total = START, rng.randrange(50)
        for _ in range(150):
            at += timedelta(seconds=rng.choice([15, 15, 15, 16, 60, 700, 4000, 30_000]), microseconds=rng.randrange(1000))
            total = rng.randrange(5) if rng.random() < 0.1 else total + rng.randrange(6)
            samples.append((job, at, total))
            if rng.random() < 0.05:
                samples.append((job, at, max(0, total - 3)))    # told twice: the higher one counts
    frame = spark.createDataFrame(samples, SAMPLES).repartition(5)
    got = counters.over_ranges(frame, ["job"], "at", "total", 300, 60, counter).select("job", "at", "samples", "resets", "increase")
    want = plain(samples, 300, 60, counter)
    found = rows(got, "job", "at")
    assert [f[:4] for f in found] == [w[:4] for w in want] and len(found) > 300
    assert [f[4] for f in found] == pytest.approx([w[4] for w in want], abs=1e-9)


def at(*minutes):
    return [START + timedelta(minutes=m) for m in minutes]


def test_a_restart_counts_from_zero_and_across_midnight(spark):
    samples = [("x", t, v) for t, v in zip(at(1438, 1439, 1441, 1442), (100, 103, 2, 4), strict=True)]
    got = counters.over_ranges(spark.createDataFrame(samples, SAMPLES), ["job"], "at", "total", 600, 300)
    one = got.where("at = timestamp_ntz'2026-01-02 00:05:00'").first()
    assert (one.samples, one.resets) == (4, 1)
    # 3 + 2 + 2 over 4 minutes, half a spacing of 80 s to the front and 3 minutes to the end, cut to half a spacing too
    assert one.increase == pytest.approx(7 * (240 + 40 + 40) / 240) and one.per_second == pytest.approx(one.increase / 600)


def test_a_young_counter_is_not_extended_below_zero(spark):
    samples = [("x", t, v) for t, v in zip(at(4, 5), (1, 3), strict=True)]
    got = counters.over_ranges(spark.createDataFrame(samples, SAMPLES), ["job"], "at", "total", 300, 300)
    assert got.first().increase == pytest.approx(2 * (60 + 30) / 60)
    gauge = counters.over_ranges(spark.createDataFrame(samples, SAMPLES), ["job"], "at", "total", 300, 300, counter=False)
    assert gauge.first().increase == pytest.approx(2 * (60 + 30) / 60)


def test_lone_samples_and_no_samples_give_no_rows(spark):
    one = spark.createDataFrame([("x", START, 4)], SAMPLES)
    assert counters.over_ranges(one, ["job"], "at", "total", 300, 60).count() == 0
    assert counters.over_ranges(one.limit(0), ["job"], "at", "total", 300, 60).count() == 0
    with pytest.raises(ValueError):
        counters.over_ranges(one, ["job"], "at", "total", 300, 70)
