"""Catalogue queries against their SQL. All of them with METERFLOW_ALL=1."""

import os

import pytest

import __spark_entry__ as entry
from meterflow.plans.queries import catalogue
from tests.compare import compare, duck
from tests.helpers import noop, plan

CORE = [
    "parse_readings", "quarantine_reasons", "duplicate_stats", "daily_usage", "zone_day_totals",
    "closed_days", "zone_windows_colombo", "renewable_share", "threshold_alerts",
    "latest_message_by_rule", "tariff_table", "quota_sample", "daily_bills", "bill_summary",
    "lineitem_bills", "latest_complete_window", "billed_days", "out_of_order_events",
    "no_data_gaps", "errors_recent", "run_ledger", "bill_ownership", "reconcile_counts",
    "constraint_findings", "verify_bills", "recompute_bills", "layer_agreement", "merge_keyed",
    "metric_rows", "report_roundtrip", "stream_final_windows",
]
NAMES = sorted(catalogue()) if os.environ.get("METERFLOW_ALL") else CORE


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_of_the_catalogue_has_sql():
    assert set(catalogue()) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, sf_dir, name):
    problem = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], sf_dir)
    assert problem is None, problem


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_no_nested_loops_or_products(spark, sf_dir):
    """Joins are keyed everywhere; files and streams are left out, they would run here."""
    skipped = ("stream_", "csv_", "report_", "store_")
    queries = entry.queries()
    for name in NAMES:
        if not name.startswith(skipped):
            p = plan(queries[name](spark, sf_dir))
            assert "NestedLoop" not in p and "Cartesian" not in p, name


def test_day_and_column_pruning(spark, sf_dir):
    from meterflow.sources import standin

    df = standin.readings(spark, sf_dir).groupBy("grid_zone").count()
    p = plan(df)
    assert "ReadSchema: struct<user_id:bigint>" in p


@pytest.mark.parametrize("limit", ["10MB", "-1"])
def test_facts_are_scanned_once_whatever_is_broadcast(spark, sf_dir, limit):
    """Beside them only the two ends of their days are looked up, in one more scan."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        for name, file, most in (("zone_windows_colombo", "events", 1), ("lineitem_bills", "lineitem", 2), ("daily_bills", "events", 2)):
            df = catalogue()[name](spark, sf_dir)
            df.collect()
            found = plan(df).split("== Initial Plan ==")[0]
            assert found.count(f"{file}.parquet") <= most + found.count("ReusedExchange"), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
