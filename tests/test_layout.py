"""What lies where: buckets that need no shuffle, files in order, differences found by fingerprints."""

import glob
import uuid

from pyspark.sql import functions as F

from meterflow.operators import audit, dedupe, energy
from meterflow.sources import bucketed, reports, standin, store
from tests.helpers import plan, rows

# -- buckets -------------------------------------------------------------------


def test_usage_from_buckets_moves_no_reading(spark, sf_dir, tmp_path):
    stored, table = standin.readings(spark, sf_dir, resent=True), f"t{uuid.uuid4().hex}"
    bucketed.write_bucketed(stored, table, str(tmp_path / "b"), buckets=8)
    usage = bucketed.daily_usage(spark, table)
    p = plan(usage)
    assert "Exchange" not in p and "SelectedBucketsCount: 8 out of 8" in p
    expected = energy.daily_usage(dedupe.dedupe_readings(stored))
    assert usage.exceptAll(expected).count() == 0 and expected.exceptAll(usage).count() == 0
    files = glob.glob(f"{tmp_path}/b/sim_day=*/part-*")
    assert len(files) <= 8 * len(glob.glob(f"{tmp_path}/b/sim_day=*"))
    one = plan(bucketed.daily_usage(spark, table).where("sim_day = date'2024-01-15'"))
    assert "Exchange" not in one and "PartitionFilters: [isnotnull(sim_day" in one
    spark.sql(f"DROP TABLE {table}")


# -- report in order -----------------------------------------------------------

def bills(spark, n, days=1):
    row = {c: F.lit(1.0) for c in reports.COLUMNS} | {
        "sim_day": F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") % days).cast("int")), "grid_zone": F.lit("a"),
        "household_id": F.format_string("H-%08d", F.pmod(F.xxhash64("id"), F.lit(99_999_999))), "billing_tier": F.lit("x"), "subsidy_flag": F.lit(True)}
    return spark.range(n).select(*[row[c].alias(c) for c in reports.COLUMNS])


def test_files_of_a_split_day_follow_one_another(spark, tmp_path):
    stored = str(tmp_path / "bills")
    bills(spark, 40_000, days=2).write.parquet(stored)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        reports.write_report(spark.read.parquet(stored), str(tmp_path / "r"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    for day in ("2026-01-01", "2026-01-02"):
        files = sorted(glob.glob(f"{tmp_path}/r/report_day={day}/part-*"))
        assert len(files) > 1
        households = [line.split(",")[1] for f in files for line in open(f).read().splitlines()[1:]]
        assert households == sorted(households) and len(households) == 20_000
    assert {r.in_order for r in reports.report_order(spark, str(tmp_path / "r")).collect()} == {True}
    # a report whose second file belongs before the first is told
    header = ",".join(reports.COLUMNS)
    for name, low in (("part-0", 5), ("part-1", 1)):
        folder = tmp_path / "w" / "report_day=2026-01-01"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{name}.csv").write_text("\n".join([header, *[f"2026-01-01,H-{low + i},a,1,1,1,x,1,true,1,1,1" for i in range(3)]]) + "\n")
    assert rows(reports.report_order(spark, str(tmp_path / "w")).select("rows", "in_order")) == [(6, False)]


# -- where two tables differ -----------------------------------------------------

BY, KEY, COLUMNS = ["day", "zone"], ["id"], ["id", "value"]
SCHEMA = "day string, zone string, id int, value string"


def located(left, right, parts=16):
    marks = [audit.fingerprints(side, BY, KEY, COLUMNS, parts) for side in (left, right)]
    ranges = audit.differing_ranges(*marks, BY)
    return ranges, audit.differing_rows(left, right, ranges, BY, KEY, COLUMNS, parts)


def test_changed_missing_added_and_repeated_rows_are_found(spark):
    same = [(f"d{i % 5}", "ab"[i % 2], i, f"v{i}") for i in range(500)]
    left = [r for r in same if r[2] != 17] + [("d9", "a", 1, "x")] + [same[40]] + [("d1", None, 3, None)]
    right = [(*r[:3], "other") if r[2] == 99 else r for r in same] + [("d1", None, 3, "y")]
    ranges, found = located(*(spark.createDataFrame(side, SCHEMA).repartition(3) for side in (left, right)))
    assert sorted(map(tuple, found.where("zone is not null").collect())) == sorted([
        ("d2", "b", 17, "v17", -1), ("d9", "a", 1, "x", 1), ("d0", "a", 40, "v40", 1), ("d4", "b", 99, "v99", 1), ("d4", "b", 99, "other", -1)])
    assert ranges.where("day <> 'd9' and zone is not null").select(*BY).distinct().count() == 3


def test_equal_tables_in_another_order_differ_nowhere(spark):
    left = spark.range(2000).selectExpr("string(id % 7) AS day", "string(id % 3) AS zone", "int(id) AS id", "string(id) AS value")
    ranges, found = located(left, left.orderBy(F.desc("id")).repartition(5))
    assert ranges.count() == 0 and found.count() == 0


def test_equal_groups_of_a_store_are_not_opened(spark, tmp_path):
    frame = spark.range(3000).selectExpr("concat('d', id % 10) AS day", "concat('z', id % 3) AS zone", "int(id) AS id", "string(id) AS value")
    for name, side in (("l", frame), ("r", frame.withColumn("value", F.when(F.col("id") == 41, "x").otherwise(F.col("value"))))):
        side.write.partitionBy(*BY).parquet(f"{tmp_path}/{name}")
    left, right = (spark.read.parquet(f"{tmp_path}/{n}") for n in "lr")
    audit.differing_ranges(*(audit.fingerprints(s, BY, KEY, COLUMNS) for s in (left, right)), BY).write.parquet(f"{tmp_path}/ranges")
    found = audit.differing_rows(left, right, spark.read.parquet(f"{tmp_path}/ranges"), BY, KEY, COLUMNS)
    assert sorted(map(tuple, found.collect())) == [("d1", "z2", 41, "41", 1), ("d1", "z2", 41, "x", -1)]
    assert plan(found).count("dynamicpruning") >= 2


def test_a_store_without_replays_differs_by_the_replays(spark, sf_dir, tmp_path):
    stored = standin.readings(spark, sf_dir, resent=True)
    columns = ["meter_id", "timestamp", "ingested_at"]
    by, key = ["sim_day", "grid_zone"], ["meter_id", "timestamp"]
    unique = dedupe.dedupe_readings(stored)
    marks = [audit.fingerprints(s, by, key, columns) for s in (stored, unique)]
    found = audit.differing_rows(stored, unique, audit.differing_ranges(*marks, by), by, key, columns)
    assert found.count() == stored.count() - unique.count() > 0 and found.where("more <> 1").count() == 0
    store.append_readings(unique.drop("position", "event_type"), str(tmp_path / "s"))
    again = store.read_readings(spark, str(tmp_path / "s"), dedupe=False)
    assert audit.differing_ranges(marks[1], audit.fingerprints(again, by, key, columns), by).count() == 0
