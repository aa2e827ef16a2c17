from datetime import date

import pytest
from pyspark.sql import functions as F

from meterflow import __main__ as cli
from meterflow.plans import billing_run
from meterflow.sources import records, reports, standin, store, tariff_files
from tests.helpers import rows


@pytest.fixture(scope="module")
def folders(spark, sf_dir, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("run"))
    stored = standin.readings(spark, sf_dir, resent=True).select(*records.READING_COLUMNS)
    store.append_readings(stored, f"{base}/store")
    tariff_files.write_tariff(standin.tariff(spark, sf_dir), f"{base}/tariff")
    return {name: f"{base}/{name}" for name in ("store", "tariff", "bills", "report", "ledger")}


def bill(spark, folders, run_id, day=None, **options):
    return billing_run.run(spark, folders["store"], folders["tariff"], folders["bills"],
                           folders["report"], folders["ledger"], run_id, day, **options)


def test_day_to_bill(spark, folders):
    assert billing_run.resolve_day(spark, folders["store"]) == date(2024, 1, 30)
    assert billing_run.resolve_day(spark, folders["store"], date(2024, 1, 7)) == date(2024, 1, 7)
    with pytest.raises(billing_run.RunRefused, match="open"):
        billing_run.resolve_day(spark, folders["store"], date(2024, 1, 31))
    assert billing_run.resolve_day(spark, folders["store"], date(2024, 1, 31), True) == date(2024, 1, 31)


def test_a_run_and_its_rerun(spark, sf_dir, folders):
    from meterflow.plans.queries import Model

    day = date(2024, 1, 7)
    first = bill(spark, folders, "run-1", day).first()
    bill(spark, folders, "run-2", day)
    bill(spark, folders, "run-3")
    bills = billing_run.read_bills(spark, folders["bills"])
    expected = Model(spark, sf_dir).bills().where(F.col("sim_day") == F.lit(day))
    columns = expected.columns
    mine = bills.where(F.col("sim_day") == F.lit(day))
    assert mine.select(columns).exceptAll(expected).count() == 0 and mine.count() == expected.count()
    assert first.households == mine.count()
    assert {r.run_id for r in mine.select("run_id").distinct().collect()} == {"run-2"}
    assert {r.sim_day for r in bills.select("sim_day").distinct().collect()} == {day, date(2024, 1, 30)}
    report = reports.read_report(spark, folders["report"])
    assert reports.check_report(report, bills).where("not ok").count() == 0
    runs = billing_run.read_ledger(spark, folders["ledger"])
    assert rows(runs.select("run_id", "status", "rows_written"), "run_id")[0] == ("run-1", "SUCCESS", mine.count())


def test_a_run_without_rates_fails_and_writes_nothing(spark, sf_dir, folders, tmp_path):
    some = standin.tariff(spark, sf_dir, priced_segments_only=True)
    tariff_files.write_tariff(some, f"{tmp_path}/tariff")
    with pytest.raises(billing_run.RunRefused, match="without a rate: H-"):
        bill(spark, {**folders, "tariff": f"{tmp_path}/tariff", "bills": f"{tmp_path}/bills"}, "run-bad", date(2024, 1, 8))
    assert not (tmp_path / "bills").exists()
    found = spark.read.parquet(f"{folders['ledger']}-findings/run_id=run-bad").where("level = 'refused'")
    machinery = standin.households(spark, sf_dir).where("segment = 'MACHINERY'")
    assert found.join(machinery, "household_id", "left_anti").count() == 0 and found.count() > 1
    runs = billing_run.read_ledger(spark, folders["ledger"])
    assert rows(runs.where("run_id = 'run-bad'").select("status", "rows_written")) == [("FAILED", 0)]


def test_an_empty_day_is_refused(spark, folders):
    with pytest.raises(ValueError, match="no rows"):
        bill(spark, folders, "run-empty", date(2023, 1, 1), allow_open=True)


def test_command_line(spark, sf_dir, folders, tmp_path, capsys):
    cli.main(["inspect", "--store", folders["store"], "--day", "20240107"])
    assert "duplicate_rows" in capsys.readouterr().out
    standin.households(spark, sf_dir).write.parquet(f"{tmp_path}/households")
    cli.main(["tariff", "--households", f"{tmp_path}/households", "--from-day", "20240107",
              "--to-day", "2024-01-07", "--out", f"{tmp_path}/rates"])
    cli.main(["bill", "--day", "2024-01-07", *[a for n in ("store", "bills", "report", "ledger")
              for a in (f"--{n}", folders[n])], "--tariff", f"{tmp_path}/rates"])
    assert "net_amount" in capsys.readouterr().out
    households = billing_run.read_bills(spark, folders["bills"]).where("sim_day = '2024-01-07'").count()
    gate = ["verify", "--bills", folders["bills"], "--ledger", folders["ledger"], "--day", "20240107", "--households"]
    cli.main([*gate, str(households)])
    with pytest.raises(SystemExit):
        cli.main([*gate, str(households + 1)])
    text = standin.readings(spark, sf_dir)
    text.select(records.to_records(text)).write.text(f"{tmp_path}/topic")
    for job, out in (("raw-store", "s"), ("metrics", "m")):
        cli.main([job, "--files", f"{tmp_path}/topic", "--out", f"{tmp_path}/{out}",
                  "--checkpoint", f"{tmp_path}/c-{job}", "--once", "--ledger", f"{tmp_path}/l", "--progress", f"{tmp_path}/p"])
    runs = billing_run.read_ledger(spark, f"{tmp_path}/l")
    assert rows(runs.select("component", "status"), "component") == [("raw_store", "SUCCESS"), ("speed_layer", "SUCCESS")]
    assert spark.read.parquet(f"{tmp_path}/s").count() == 1000
    assert spark.read.parquet(f"{tmp_path}/m/alerts").count() > 0
    with pytest.raises(SystemExit):
        cli.main(["bill", "--day", "tomorrow", *[a for n in folders for a in (f"--{n}", folders[n])]])
