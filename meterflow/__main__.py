"""Command line: ``python -m meterflow <job> ...`` on the session Spark is started with."""

from __future__ import annotations

import argparse
import dataclasses
import uuid

from pyspark.sql import SparkSession, functions as F

from meterflow import settings
from meterflow.functions import times
from meterflow.operators import dedupe, energy, sampling
from meterflow.plans import billing_run
from meterflow.settings import AlertThresholds, StreamSettings
from meterflow.sources import records, store, streams, tariff_files
from meterflow.streaming import jobs


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="meterflow", description=__doc__)
    parser.add_argument("--timezone", default=settings.TIMEZONE)
    jobs_of = parser.add_subparsers(dest="job", required=True)

    def job(name, text):
        return jobs_of.add_parser(name, help=text)

    for name, text in (("raw-store", "records to the partitioned store"),
                       ("metrics", "records to zone windows and alerts")):
        p = job(name, text)
        p.add_argument("--bootstrap", help="Kafka servers; needs --topic")
        p.add_argument("--topic")
        p.add_argument("--files", help="folder of text files with one record a line")
        p.add_argument("--start", default="earliest", choices=("earliest", "latest"))
        p.add_argument("--out", required=True)
        p.add_argument("--checkpoint", required=True)
        p.add_argument("--once", action="store_true", help="take what is there and stop")
        p.add_argument("--early", action="store_true", help="warn on windows still filling")
        p.add_argument("--ledger", help="record the run in this ledger")
        p.add_argument("--progress", help="append every progress report to this table")
        p.add_argument("--seconds", type=int, help="trigger interval")
        p.add_argument("--window-minutes", type=int, default=StreamSettings().window_minutes)
        p.add_argument("--watermark-minutes", type=int, default=StreamSettings().watermark_minutes)
        p.add_argument("--overload-kw", type=float, default=AlertThresholds().overload_kw_per_meter)
        p.add_argument("--horizon-windows", type=int, help="how far back logged alerts are looked up")
    p = job("bill", "bill one stored day")
    for path in ("store", "tariff", "bills", "report", "ledger"):
        p.add_argument(f"--{path}", required=True)
    p.add_argument("--day", help="YYYYMMDD or YYYY-MM-DD; default: the newest closed day")
    p.add_argument("--allow-open-day", action="store_true")
    p = job("verify", "check the bills of one day; exit code 1 if a check fails")
    for path in ("bills", "ledger", "day"):
        p.add_argument(f"--{path}", required=True)
    p.add_argument("--households", type=int, required=True, help="configured households")
    p = job("tariff", "write the rate files of some days")
    p.add_argument("--households", required=True, help="Parquet table with household_id")
    p.add_argument("--from-day", required=True)
    p.add_argument("--to-day", required=True)
    p.add_argument("--out", required=True)
    p = job("inspect", "show what the store holds")
    p.add_argument("--store", required=True)
    p.add_argument("--day")
    return parser


def _day(spark, text):
    day = spark.range(1).select(times.parse_day(F.lit(text))).first()[0]
    if day is None:
        raise SystemExit(f"a day looks like 20260127 or 2026-01-27, not {text!r}")
    return day


def _source(spark, args):
    if args.files:
        return streams.file_records(spark, args.files)
    if not (args.bootstrap and args.topic):
        raise SystemExit("give --files, or --bootstrap and --topic")
    return streams.kafka_records(spark, streams.kafka_options(args.bootstrap, args.topic, args.start))


def _live(args):
    return StreamSettings(timezone=args.timezone, window_minutes=args.window_minutes,
                          watermark_minutes=args.watermark_minutes)


def _recorded(spark, args, component, run_id, start):
    """Runs a stream job to its end, with its start and finish in the ledger if asked for.

    A run that was killed stays open there until the next start of the job supersedes it.
    """
    if args.progress:
        spark.streams.addListener(jobs.ProgressLog(spark, args.progress))
    if args.ledger:
        billing_run.record(spark, args.ledger, run_id, "start", component=component)
    status = "FAILED"
    try:
        start().awaitTermination()
        status = "SUCCESS"
    finally:
        if args.ledger:
            billing_run.record(spark, args.ledger, run_id, "finish", status=status, component=component)


def raw_store(spark, args):
    seconds = {"seconds": args.seconds} if args.seconds else {}
    _recorded(spark, args, "raw_store", f"raw-{uuid.uuid4().hex[:8]}", lambda: jobs.start_raw_store(
        _source(spark, args), args.out, args.checkpoint, "raw_store", _live(args), args.once, **seconds))


def metrics(spark, args):
    live, run_id = _live(args), f"speed-{uuid.uuid4().hex[:8]}"
    seconds = {"seconds": args.seconds} if args.seconds else {}
    parsed = records.parse_readings(_source(spark, args), args.timezone, utc=False)
    windows = jobs.zone_window_stream(parsed, live, "approx" if args.early else "exact")
    limits = dataclasses.replace(AlertThresholds(), overload_kw_per_meter=args.overload_kw)
    _recorded(spark, args, "speed_layer", run_id, lambda: jobs.start_metrics_and_alerts(
        windows, f"{args.out}/zone_metrics", f"{args.out}/alerts", args.checkpoint, "metrics", run_id, live, limits,
        args.once, "update" if args.early else "append", horizon_windows=args.horizon_windows, **seconds))


def bill(spark, args):
    day = _day(spark, args.day) if args.day else None
    summary = billing_run.run(spark, args.store, args.tariff, args.bills, args.report, args.ledger,
                              f"billing-{uuid.uuid4().hex[:8]}", day, args.allow_open_day, args.timezone)
    summary.show(truncate=False)


def verify(spark, args):
    checks = billing_run.verify(spark, args.bills, args.ledger, _day(spark, args.day), args.households)
    checks.show(truncate=False)
    if not checks.where("not ok").isEmpty():
        raise SystemExit(1)


def tariff(spark, args):
    days = [F.lit(_day(spark, text)) for text in (args.from_day, args.to_day)]
    households = spark.read.parquet(args.households)
    tariff_files.write_tariff(sampling.rate_table(households, *days), args.out)


def inspect(spark, args):
    stored = store.read_readings(spark, args.store, dedupe=False)
    stored.printSchema()
    dedupe.duplicate_stats(stored).show()
    unique = dedupe.dedupe_readings(stored)
    counts = energy.partition_counts(unique)
    print(f"{counts.count()} days and zones, the newest of them:")
    counts.orderBy(F.desc("sim_day"), "grid_zone").show(40, truncate=False)
    day = _day(spark, args.day) if args.day else store.stored_days(spark, args.store).first()[0]
    chosen = unique.where(F.col("sim_day") == F.lit(day))
    energy.zone_day_totals(chosen).orderBy("grid_zone").show(truncate=False)
    chosen.show(3, truncate=False)


def main(argv=None):
    args = _arguments().parse_args(argv)
    spark = SparkSession.builder.appName(f"meterflow-{args.job}").getOrCreate()
    {"raw-store": raw_store, "metrics": metrics, "bill": bill, "verify": verify,
     "tariff": tariff, "inspect": inspect}[args.job](spark, args)


if __name__ == "__main__":
    main()
