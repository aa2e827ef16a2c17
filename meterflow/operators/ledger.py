"""Run ledger: appended start and finish events folded to the state of each run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Notes as readers of the ledger know them.
NOTE_SEPARATOR = " | "
SUPERSEDED = "did not shut down cleanly; superseded by "


def start_event(runs: DataFrame) -> DataFrame:
    """Start events from (run_id, component, sim_day, at, notes)."""
    return runs.select("run_id", "component", "sim_day", "at", F.lit("start").alias("kind"),
                       F.lit(None).cast("string").alias("status"),
                       F.lit(None).cast("bigint").alias("rows_written"), "notes")


def finish_event(runs: DataFrame) -> DataFrame:
    """Finish events from (run_id, component, at, status, rows_written)."""
    return runs.select("run_id", "component", F.lit(None).cast("date").alias("sim_day"), "at",
                       F.lit("finish").alias("kind"), "status", "rows_written",
                       F.lit(None).cast("string").alias("notes"))


def fold(events: DataFrame) -> DataFrame:
    """State of every run.

    A run starts RUNNING. The next start of the same component marks it FAILED with a
    note if it has not finished by then; its own finish event, whenever it comes, sets
    status and end. The next start is looked up inside (component, start day) and, at the
    end of a day, on one line per component and day.
    """
    is_start, is_finish = F.col("kind") == "start", F.col("kind") == "finish"
    per_run = events.groupBy("run_id", "component").agg(
        F.max(F.when(is_start, F.col("sim_day"))).alias("sim_day"),
        F.min(F.when(is_start, F.col("at"))).alias("started_at"),
        F.max(F.when(is_start, F.col("notes"))).alias("notes"),
        F.max_by(F.when(is_finish, F.col("status")), F.when(is_finish, F.col("at")))
        .alias("own_status"),
        F.max(F.when(is_finish, F.col("at"))).alias("own_finish"),
        F.max_by(F.when(is_finish, F.col("rows_written")), F.when(is_finish, F.col("at")))
        .alias("rows_written"),
    ).where("started_at is not null")
    starts = events.where(is_start).select("run_id", "component", F.col("at").alias("started_at"))
    followed = next_start(per_run, starts)
    superseded = F.col("next_at").isNotNull() & (
        F.col("own_finish").isNull() | (F.col("own_finish") > F.col("next_at"))
    )
    note = F.when(superseded, F.concat(F.lit(SUPERSEDED), F.col("next_run")))
    return followed.select(
        "run_id", "component",
        F.coalesce("own_status", F.when(superseded, F.lit("FAILED")), F.lit("RUNNING"))
        .alias("status"),
        "sim_day", "started_at",
        F.coalesce("own_finish", F.when(superseded, F.col("next_at"))).alias("finished_at"),
        "rows_written",
        F.nullif(F.concat_ws(NOTE_SEPARATOR, "notes", note), F.lit("")).alias("notes"),
    )


def next_start(runs: DataFrame, starts: DataFrame) -> DataFrame:
    """Adds the time and id of the next start in the component; ties go by run id.

    The first start of each day is taken from the start events themselves, so the runs
    are folded once.
    """
    place = F.struct(F.col("started_at").alias("at"), F.col("run_id").alias("run"))
    day = F.to_date("started_at")
    heads = starts.groupBy("component", day.alias("_day")).agg(F.min(place).alias("_head"))
    days = Window.partitionBy("component").orderBy("_day")
    following = heads.select("component", "_day", F.lead("_head").over(days).alias("_next_day"))
    dated = runs.withColumn("_day", day).withColumn("_place", place)
    inside = Window.partitionBy("component", "_day").orderBy("_place")
    joined = dated.withColumn("_next", F.lead("_place").over(inside)).join(
        following, ["component", "_day"], "left"
    )
    chosen = F.coalesce("_next", "_next_day")
    return joined.select(
        *runs.columns, chosen["at"].alias("next_at"), chosen["run"].alias("next_run")
    )


def superseded_by(runs: DataFrame, run_id: str) -> DataFrame:
    """Runs that the start of ``run_id`` marked as not shut down cleanly."""
    return runs.where(F.endswith(F.col("notes"), F.lit(SUPERSEDED + run_id)))


def counts(runs: DataFrame) -> DataFrame:
    return runs.groupBy("component", "status").agg(F.count(F.lit(1)).alias("runs"))


def recent(runs: DataFrame, limit: int = 15) -> DataFrame:
    return runs.select("run_id", "component", "status", "sim_day", "started_at", "finished_at",
                       "rows_written").orderBy(F.col("started_at").desc(), "run_id").limit(limit)


def newest_per_day(runs: DataFrame, component: str) -> DataFrame:
    """Newest run of each day with the number of runs the day has had."""
    place = F.struct("started_at", "run_id")
    newest = F.struct("run_id", "status", "rows_written", "started_at", "finished_at")
    per_day = runs.where(F.col("component") == component).groupBy("sim_day").agg(
        F.max_by(newest, place).alias("r"), F.count(F.lit(1)).alias("times_run")
    )
    took = F.timestamp_diff("SECOND", F.col("r.started_at"), F.col("r.finished_at"))
    return per_day.select("sim_day", "r.run_id", "r.status", "r.rows_written",
                          took.alias("seconds"), "times_run")


def last_success_seconds(runs: DataFrame) -> DataFrame:
    """Per component the duration of the newest successful run; failed runs are ignored."""
    took = F.timestamp_diff("SECOND", "started_at", "finished_at")
    return (
        runs.where("status = 'SUCCESS' and finished_at is not null")
        .groupBy("component")
        .agg(F.max_by(took, F.struct("finished_at", "run_id")).alias("seconds"))
    )


def failed_in_last(runs: DataFrame, minutes: int, now: Column) -> DataFrame:
    """Per component the failures in the minutes up to ``now``; 0 where there are none."""
    since = now - F.make_dt_interval(mins=F.lit(minutes))
    recent_failure = ((F.col("status") == "FAILED") & (F.col("finished_at") > since)
                      & (F.col("finished_at") <= now))
    return runs.groupBy("component").agg(F.count_if(recent_failure).alias("failed"))
