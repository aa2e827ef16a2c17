"""Latest-per-group, top-k, neighbours in an order, gaps.

Nothing here sorts an unbounded group in one task: rank filters are cut before the
shuffle, neighbours are found inside buckets and on their ends, gaps on pre-aggregated
buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_per_group(df: DataFrame, by: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows of each group in the order; planned as a group limit on both
    sides of the shuffle."""
    window = Window.partitionBy(*by).orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= n)
    return ranked.drop("_rank")


def with_overall(df: DataFrame, **aggregates: Column) -> DataFrame:
    """Adds aggregates over the whole frame to every row.

    Only for summaries with one row per day, zone or partition: the frame passes one
    task, and computing it twice for a join would cost more than that.
    """
    everything = Window.partitionBy()
    return df.select("*", *[agg.over(everything).alias(name) for name, agg in aggregates.items()])


def latest_windows(zone_metrics: DataFrame, complete_only: bool = True) -> DataFrame:
    """Newest window per zone, by default the newest one before the open window.

    The open window is the newest of the whole table. A zone's answer is always among
    its own two newest rows, so two rows per zone are kept and the rest is decided on
    them, in one pass over the metrics.
    """
    newest_first = [F.col("window_start").desc()]
    if not complete_only:
        return latest_per_group(zone_metrics, ["grid_zone"], newest_first)
    two = latest_per_group(zone_metrics, ["grid_zone"], newest_first, n=2)
    seen = with_overall(two, _open=F.max("window_start"))
    complete = seen.where(F.col("window_start") < F.col("_open")).drop("_open")
    return latest_per_group(complete, ["grid_zone"], newest_first)


def top(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows of the whole frame; each task keeps its own n first."""
    return df.orderBy(*order).limit(n)


def newest_then_ascending(df: DataFrame, column: str, n: int) -> DataFrame:
    return df.orderBy(F.col(column).desc()).limit(n).orderBy(column)


def out_of_order(df: DataFrame, source: str, order: list[str], value: str, bucket: Column) -> DataFrame:
    """Per source: rows, and rows whose value is below that of the row just before.

    ``bucket`` must rise with the order and be fine enough that one source's bucket is a
    small piece of work: neighbours are compared inside buckets, so a source with a large
    share of the rows spans many tasks, and the seams on one line per bucket.
    """
    rows = df.select(source, F.struct(*order).alias("_order"), F.col(value).alias("_value"), bucket.alias("_bucket"))
    seen = previous_in_order(rows, [source], "_order", "_value", "_bucket")
    return seen.groupBy(source).agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("_value") < F.col("previous")).alias("out_of_order"))


def gaps(df: DataFrame, time: str, limit_seconds: int, by: list[str] | None = None) -> DataFrame:
    """Silences longer than the limit between consecutive times, per group if given.

    A no-data condition that must hold for a while is a gap above limit plus hold time.

    Two times more than the limit apart never share a bucket of that width, so a gap can
    only lie between the last time of one bucket and the first of the next. Rows are
    reduced to one line per bucket before anything is sorted, neighbours are compared
    inside a day, and days are joined up on one line per day.
    """
    by = by or []
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    width = limit_seconds * 1_000_000
    bucketed = df.groupBy(
        *by, F.floor(F.timestamp_diff("MICROSECOND", epoch, F.col(time)) / width).alias("bucket")
    ).agg(F.min(time).alias("first_at"), F.max(time).alias("last_at"))
    dated = bucketed.withColumn("day", F.to_date("first_at"))
    before = previous_in_order(dated, by, "first_at", "last_at", "day")
    return before.where(
        F.timestamp_diff("MICROSECOND", "previous", "first_at") > width
    ).select(
        *by, F.col("previous").alias("gap_start"), F.col("first_at").alias("gap_end"),
        F.timestamp_diff("SECOND", "previous", "first_at").alias("gap_seconds"),
    )


def previous_in_order(df: DataFrame, by: list[str], order: str, value: str,
                      bucket: str) -> DataFrame:
    """Adds ``previous``: the value of the row before, in two levels.

    ``bucket`` must rise with ``order``. Rows are compared inside (group, bucket); the
    first row of a bucket takes the last value of the bucket before it, found on one
    line per bucket.
    """
    inside = Window.partitionBy(*by, bucket).orderBy(order)
    local = df.withColumn("_inside", F.lag(value).over(inside)).withColumn(
        "_first", F.row_number().over(inside) == 1
    )
    ends = df.groupBy(*by, bucket).agg(F.max_by(value, order).alias("_end"))
    ends = ends.withColumn(
        "_carried", F.lag("_end").over(Window.partitionBy(*by).orderBy(bucket))
    ).drop("_end")
    return (
        local.join(ends, [*by, bucket], "left")
        .withColumn("previous", F.when(F.col("_first"), F.col("_carried"))
                    .otherwise(F.col("_inside")))
        .drop("_inside", "_first", "_carried")
    )


def trailing_counts(df: DataFrame, time: str, by: list[str], minutes: int) -> DataFrame:
    """Rows per group in the ``minutes`` minutes ending with each minute.

    Counted per minute first; each minute's count is then added to the windows that
    contain it. Only minutes with a non-zero count appear.
    """
    per_minute = df.groupBy(*by, F.date_trunc("minute", F.col(time)).cast("timestamp_ntz")
                            .alias("minute")).agg(F.count(F.lit(1)).alias("n"))
    ahead = F.explode(F.sequence(F.lit(0), F.lit(minutes - 1)))
    spread = per_minute.select(*by, "minute", "n", ahead.alias("step"))
    return (
        spread.select(*by, "n", (F.col("minute") + F.make_dt_interval(mins=F.col("step")))
                      .alias("at_minute"))
        .groupBy(*by, "at_minute").agg(F.sum("n").alias("in_window"))
    )
