"""A table of base and batches: what is read, what is rewritten, what a crash leaves."""

import os

import pytest

from meterflow.streaming import jobs
from meterflow.streaming.live_table import LiveTable
from meterflow.workspace import children
from tests.helpers import plan, rows

KEY = ["hour", "zone"]


@pytest.fixture
def table(spark, tmp_path):
    return LiveTable(spark, str(tmp_path / "t"), KEY, buckets=8)


def put(table, batch, *values, life="1", query="q"):
    frame = table.spark.createDataFrame(list(values), "hour int, zone string, kwh int")
    jobs.write_version(frame, table.path, query, life, batch)


def held(table, **options):
    return {(r.hour, r.zone): r.kwh for r in table.read(**options).collect()}


def opened(table):
    """The folders a read opens, without the files' own names."""
    return sorted({os.path.dirname(f).split("/t/")[1] for f in table.versions().inputFiles()})


def test_nothing_to_read_before_the_first_batch(table):
    assert table.read() is None and table.compact() is None and table.vacuum() == 0


def test_a_read_opens_the_base_and_later_batches_only(table):
    put(table, 0, (0, "a", 1), (1, "a", 1), (1, "b", 1))
    put(table, 1, (1, "a", 2), (2, "a", 2))
    before = held(table)
    manifest = table.compact()
    assert held(table) == before == {(0, "a"): 1, (1, "a"): 2, (1, "b"): 1, (2, "a"): 2}
    base = [f"base/{1:012d}/bucket={b}" for b in sorted(manifest.buckets)]
    assert opened(table) == base
    put(table, 2, (2, "a", 3), (9, "c", 3))
    assert opened(table) == [*base, "query=q/life=1/batch_id=2"]
    assert held(table) == before | {(2, "a"): 3, (9, "c"): 3}


def test_only_reached_buckets_are_rewritten(table):
    put(table, 0, *[(h, "a", 0) for h in range(40)])
    first = table.compact()
    put(table, 1, (39, "a", 1), (39, "b", 1))
    second = table.compact()
    assert len(first.buckets) == 8 and sorted(second.buckets.values()) == [1] * 7 + [2]
    assert len(children(table.spark, f"{table.path}/base/{2:012d}")) == 2  # one bucket and the mark of success
    assert held(table) == {(h, "a"): int(h == 39) for h in range(40)} | {(39, "b"): 1}
    assert table.compact() is None


def test_a_crash_between_base_and_manifest_leaves_the_table_as_it_was(table):
    put(table, 0, (0, "a", 1), (1, "a", 1))
    table.compact()
    put(table, 1, (1, "a", 2), (3, "a", 2))
    before = held(table)
    table.merge(table.manifest(), table.fresh(table.manifest()))  # and no commit
    assert table.manifest().generation == 1 and held(table) == before
    os.makedirs(f"{table.path}/manifest/{2:012d}/_temporary")      # nor half a commit
    assert table.manifest().generation == 1 and held(table) == before
    put(table, 2, (3, "a", 5))
    assert table.compact().generation == 2 and held(table) == before | {(3, "a"): 5}


def test_a_batch_being_written_waits_with_those_after_it(table):
    put(table, 0, (0, "a", 1))
    put(table, 1, (0, "a", 2))
    put(table, 2, (0, "a", 3))
    os.remove(f"{table.path}/query=q/life=1/batch_id=1/_SUCCESS")
    assert table.compact().upto == {"query=q/life=1": 0} and held(table) == {(0, "a"): 1}
    put(table, 1, (0, "a", 2))
    assert held(table) == {(0, "a"): 3} and table.compact().upto == {"query=q/life=1": 2} and held(table) == {(0, "a"): 3}


def test_a_replayed_batch_that_the_base_holds_changes_nothing(table):
    put(table, 0, (0, "a", 1))
    table.compact()
    put(table, 0, (0, "a", 1))
    assert opened(table) == [f"base/{1:012d}/bucket={b}" for b in table.manifest().buckets] and table.compact() is None


def test_vacuum_keeps_what_newest_generations_need(table):
    for n in range(3):
        put(table, n, (n, "a", n), (50, "a", n))
        table.compact()
    put(table, 3, (0, "a", 9))
    before = held(table)
    assert table.vacuum(keep=2) > 0
    assert held(table) == before
    assert children(table.spark, f"{table.path}/query=q/life=1") == ["batch_id=2", "batch_id=3"]
    older = list(table.manifests())[1]
    assert table._base(older).count() == 3  # a reader that began before the last compaction
    assert table.vacuum(keep=1) > 0 and held(table) == before and table.vacuum(keep=1) == 0
    put(table, 4, (7, "z", 4))
    table.compact()
    assert held(table) == before | {(7, "z"): 4}


def test_the_younger_life_wins_and_queries_stay_apart(table):
    put(table, 5, (0, "a", 1), (1, "a", 1), life="1")
    put(table, 0, (0, "a", 2), life="2")
    put(table, 0, (0, "a", 7), query="other", life="0")
    for _ in range(2):
        assert held(table, query="q") == {(0, "a"): 2, (1, "a"): 1} and held(table, query="other") == {(0, "a"): 7}
        table.compact()


def test_new_columns_and_filters_on_the_key(table):
    put(table, 0, (0, "a", 1), (5, "a", 1))
    table.compact()
    wider = table.spark.createDataFrame([(5, "a", 2, "x")], "hour int, zone string, kwh int, note string")
    jobs.write_version(wider, table.path, "q", "1", 1)
    chosen = table.read().where("hour = 5")
    assert rows(chosen.select("kwh", "note")) == [(2, "x")]
    assert plan(chosen).count("EqualTo(hour,5)") == 2


def test_equal_to_the_view_without_compaction_over_random_batches(table):
    import random

    rng, expected = random.Random(3), {}
    for n in range(12):
        values = {(rng.randrange(30), rng.choice("abc")): rng.randrange(100) for _ in range(rng.randrange(0, 9))}
        put(table, n, *[(*k, v) for k, v in values.items()])
        expected |= values
        if n % 3 == 1:
            table.compact()
        if n % 5 == 4:
            table.vacuum()
        assert (held(table) if table.read() is not None else {}) == expected
