from datetime import date

import pytest
from pyspark.sql import functions as F

from meterflow.operators import audit, billing
from meterflow.sources import reports, store, streams, tariff_files
from meterflow.workspace import materialised, shared_folder
from tests.helpers import at, plan, readings, rows

ROWS = [(1, "a", 1, 0, "2026-01-01T01:00"), (2, "b c", 2, 0, "2026-01-01T02:00"),
        (1, "a", 3, 0, "2026-01-02T01:00")]


def folder(tmp_path, name="t"):
    return str(tmp_path / name)


def write_file(tmp_path, name, text):
    path = tmp_path / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


# -- store -------------------------------------------------------------------

def test_day_filter_reads_one_folder(spark, tmp_path):
    path = folder(tmp_path)
    store.append_readings(readings(spark, ROWS), path)
    one = store.read_readings(spark, path, "2026-01-02")
    assert rows(one.select("meter_id", "power_consumption_kwh")) == [("M-1", 3.0)]
    assert "PartitionFilters: [isnotnull(sim_day" in plan(one)
    later = store.read_readings(spark, path).where(F.col("sim_day") == F.lit("2026-01-02").cast("date"))
    assert "PartitionFilters: [isnotnull(sim_day" in plan(later), "a filter after the dedupe prunes too"


def test_writing_a_batch_twice_changes_nothing(spark, tmp_path):
    path, df = folder(tmp_path), readings(spark, ROWS)
    for batch in ("q-0", "q-1", "q-1"):
        store.write_batch(df, path, batch)
    assert spark.read.parquet(path).count() == 6
    assert store.read_readings(spark, path).count() == 3
    assert rows(store.store_summary(spark, path).select("rows", "distinct_readings")) == [(6, 3)]


def test_appends_and_batches_share_a_store(spark, tmp_path):
    path, df = folder(tmp_path), readings(spark, ROWS)
    store.append_readings(df, path)
    store.write_batch(df, path, "q-0")
    store.append_readings(df, path)
    assert spark.read.parquet(path).count() == 9 and store.read_readings(spark, path).count() == 3
    assert [str(r.sim_day) for r in store.stored_days(spark, path).collect()] == ["2026-01-02", "2026-01-01"]


def test_layout_names_stray_files(spark, tmp_path):
    path = folder(tmp_path)
    store.write_batch(readings(spark, ROWS), path, "q-0")
    columns = spark.read.parquet(path)
    assert audit.missing_columns(columns, store.DATA_COLUMNS | {"voltage"}) == ["voltage"]
    readings(spark, ROWS).limit(1).coalesce(1).write.parquet(f"{path}/stray")
    found = rows(store.layout_check(spark, path).groupBy("sim_day", "grid_zone", "fits").count(), "sim_day", "grid_zone")
    assert [(d, z, f) for d, z, f, _ in found] == [
        (None, None, False), ("2026-01-01", "a", True), ("2026-01-01", "b c", True), ("2026-01-02", "a", True)]


def test_compaction_removes_replays(spark, tmp_path):
    path, target = folder(tmp_path), folder(tmp_path, "compact")
    for batch in ("q-0", "q-1"):
        store.write_batch(readings(spark, ROWS), path, batch)
    store.compact_days(spark, path, target, ["2026-01-01"])
    assert spark.read.parquet(target).count() == 2
    assert store.layout_check(spark, target).where("not fits").count() == 0


def test_an_empty_day_stops_the_run(spark):
    with pytest.raises(ValueError, match="no rows"):
        store.require_rows(readings(spark, []), "2026-01-01")
    store.require_rows(readings(spark, ROWS), "2026-01-01")


# -- rate files --------------------------------------------------------------

HEADER = "household_id,tariff_rate,billing_tier,subsidy_flag\n"


def test_rate_file_is_typed_and_dated_by_its_name(spark, tmp_path):
    write_file(tmp_path, "in/tariff_20260121.csv", HEADER + "H-1,45.00,domestic-2, True \nH-2,30.5,domestic-1,FALSE\n")
    assert tariff_files.file_name(date(2026, 1, 21)) == "tariff_20260121.csv"
    got = rows(tariff_files.read_tariff(spark, str(tmp_path / "in")), "household_id")
    assert [(str(d), h, float(r), t, f) for d, h, r, t, f in got] == [
        ("2026-01-21", "H-1", 45.0, "domestic-2", True), ("2026-01-21", "H-2", 30.5, "domestic-1", False)]
    assert tariff_files.available(spark, str(tmp_path / "in")).count() == 1
    write_file(tmp_path, "in/tariff_20260122.csv", HEADER + "H-1,,broken,true\n")
    assert tariff_files.read_day(spark, str(tmp_path / "in"), date(2026, 1, 21)).count() == 2
    with pytest.raises(ValueError, match="missing tariff_rate"):
        tariff_files.read_day(spark, str(tmp_path / "in"), date(2026, 1, 22))
    with pytest.raises(ValueError, match="tariff_20260123.csv is missing"):
        tariff_files.read_day(spark, str(tmp_path / "in"), date(2026, 1, 23))
    single = write_file(tmp_path, "other.csv", HEADER + "H-7,1.5,domestic-1,true\n")
    assert rows(tariff_files.read_day(spark, single, date(2026, 1, 5)).select("sim_day", "household_id")) == [
        (date(2026, 1, 5), "H-7")]


@pytest.mark.parametrize("line, word", [
    ("H-1,,domestic-2,true", "missing tariff_rate"), ("H-1,45,,true", "missing billing_tier"),
    ("H-1,abc,domestic-2,true", "not a number"), (",45,domestic-2,true", "missing household_id"), ("", "no rows")])
def test_faulty_rate_files_are_errors(spark, tmp_path, line, word):
    path = write_file(tmp_path, "tariff_20260121.csv", HEADER + (line + "\n" if line else ""))
    with pytest.raises(ValueError, match=word):
        tariff_files.read_tariff(spark, path)


def test_report_of_a_day_is_replaced_alone(spark, tmp_path):
    def bills(day, *people):
        return spark.createDataFrame([(day, p) for p in people], "sim_day string, household_id string").select(
            F.col("sim_day").cast("date").alias("sim_day"), "household_id", F.lit("a").alias("grid_zone"),
            *[F.lit(1.5).cast("decimal(18,2)").alias(c) for c in (*reports.COLUMNS[3:6], "tariff_rate")],
            F.lit("domestic-1").alias("billing_tier"), F.lit(True).alias("subsidy_flag"),
            *[F.lit(2).cast("decimal(18,2)").alias(c) for c in reports.COLUMNS[9:]])

    path = folder(tmp_path)
    reports.write_report(bills("2026-01-01", "H-2", "H-1").unionByName(bills("2026-01-02", "H-1")), path)
    reports.write_report(bills("2026-01-02", "H-3"), path)
    report = reports.read_report(spark, path)
    assert rows(report.select("household_id", "sim_day").orderBy("sim_day", "household_id")) == [
        ("H-1", date(2026, 1, 1)), ("H-2", date(2026, 1, 1)), ("H-3", date(2026, 1, 2))]
    both = bills("2026-01-01", "H-2", "H-1").unionByName(bills("2026-01-02", "H-3", "H-4"))
    assert rows(reports.check_report(report, both).select("sim_day", "ok"), "sim_day") == [
        (date(2026, 1, 1), True), (date(2026, 1, 2), False)]
    text = spark.read.text(path + "/report_day=2026-01-01").first().value
    assert text == ",".join(reports.COLUMNS)


# -- options, folders --------------------------------------------------------

def test_stream_options():
    options = streams.kafka_options("host:1", "readings", "latest", maxOffsetsPerTrigger="5000")
    assert (options["subscribe"], options["startingOffsets"], options["failOnDataLoss"]) == ("readings", "latest", "false")
    with pytest.raises(ValueError):
        streams.kafka_options("host:1", "readings", "middle")
    assert streams.trigger(True, 5) == {"availableNow": True}
    assert streams.trigger(False, 5) == {"processingTime": "5 seconds"}


def test_shared_folder_comes_from_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark, "x"), shared_folder(spark, "x")
    assert first.startswith(base.rstrip("/")) and first != second


def test_materialised_keeps_rows_and_types(spark):
    df = readings(spark, ROWS)
    back = materialised(df, "readings")
    assert back.schema == df.schema or [f.dataType for f in back.schema] == [f.dataType for f in df.schema]
    assert sorted(rows(back)) == sorted(rows(df))
