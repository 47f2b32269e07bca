"""Change over time: poll series and gaps between runs.

A poll series can hold a third of all rows under one key. ``previous`` and
``running_sum`` therefore work in two levels: inside (key, time bucket), and over
the small table of bucket ends. Both levels are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions import dates

GAP_MINUTES, STALL_POLLS = 30, 10


def _bucketed(df: DataFrame, ts: str, unit: str) -> DataFrame:
    return df.withColumn("_bucket", F.date_trunc(unit, F.col(ts)))


def previous(df: DataFrame, key: list[str], order: list[str], cols: list[str], unit: str = "day") -> DataFrame:
    """Add ``prev_<col>``: the value in the row before, per key in ``order`` (its
    first column is a time)."""
    keyed = _bucketed(df, order[0], unit)
    local = Window.partitionBy(*key, "_bucket").orderBy(*order)
    ends = keyed.groupBy(*key, "_bucket").agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("_end"))
    ends = ends.withColumn("_carry", F.lag("_end").over(Window.partitionBy(*key).orderBy("_bucket"))).drop("_end")
    with_lag = keyed.withColumns({"_rn": F.row_number().over(local),
                                  "_lag": F.lag(F.struct(*cols)).over(local)})
    joined = with_lag.join(ends, [*key, "_bucket"])
    prev = F.when(F.col("_rn") == 1, F.col("_carry")).otherwise(F.col("_lag"))
    return joined.withColumn("_prev", prev).withColumns({f"prev_{c}": F.col("_prev")[c] for c in cols}).drop(
        "_bucket", "_rn", "_lag", "_carry", "_prev")


def running_sum(df: DataFrame, key: list[str], order: list[str], value: Column, name: str,
                unit: str = "day") -> DataFrame:
    """Add ``name``: the sum of ``value`` up to and including each row, per key."""
    keyed = _bucketed(df.withColumn("_v", value), order[0], unit)
    before = Window.partitionBy(*key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = keyed.groupBy(*key, "_bucket").agg(F.sum("_v").alias("_t"))
    totals = totals.withColumn("_offset", F.coalesce(F.sum("_t").over(before), F.lit(0))).drop("_t")
    local = Window.partitionBy(*key, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inside = keyed.withColumn("_s", F.sum("_v").over(local))
    return inside.join(totals, [*key, "_bucket"]).withColumn(name, F.col("_s") + F.col("_offset")).drop(
        "_bucket", "_v", "_s", "_offset")


def run_gaps(runs: DataFrame) -> DataFrame:
    """Runs starting more than 30 minutes after the previous run of the day ended."""
    days = runs.select("run_id", "start_time", "end_time", "from_date")
    seq = previous(days, ["from_date"], ["start_time", "run_id"], ["end_time"], unit="hour")
    gap = dates.minute_diff(F.col("start_time"), F.col("prev_end_time"))
    return seq.withColumn("gap_minutes", gap).filter(F.col("gap_minutes") > GAP_MINUTES)


def polls(snapshots: DataFrame) -> DataFrame:
    """The poll series with the previous totals and time."""
    return previous(snapshots, ["run_no"], ["ts", "event_id"], ["source_total", "items_fetched", "ts"])


def growth(series: DataFrame) -> DataFrame:
    return series.filter(F.col("prev_ts").isNotNull()).select(
        "run_no", "event_id", (F.col("source_total") - F.col("prev_source_total")).alias("growth"),
        dates.minute_diff(F.col("ts"), F.col("prev_ts")).alias("minutes"))


def arrivals(series: DataFrame) -> DataFrame:
    return series.filter(F.col("source_total") > F.col("prev_source_total")).select(
        "run_no", "event_id", "ts", "source_total", (F.col("source_total") - F.col("prev_source_total")).alias("new_items"),
        F.col("prev_source_total").alias("previous_total"))


def fetches(series: DataFrame) -> DataFrame:
    """Polls that saw more fetched items; before the first poll nothing was fetched."""
    delta = F.col("items_fetched") - F.coalesce("prev_items_fetched", F.lit(0))
    return series.withColumn("items", delta).filter(F.col("items") > 0).select(
        "run_no", "event_id", "ts", "items", F.col("items_fetched").alias("total_fetched"),
        F.greatest(F.lit(0), F.col("source_total") - F.col("items_fetched")).alias("remaining"))


def stalls(series: DataFrame, longer_than: int = STALL_POLLS, *more: Column) -> DataFrame:
    """Stretches of more than ``longer_than`` polls of a RUNNING run without progress. A poll with more items, or in
    another status, ends a stretch and belongs to none."""
    moved = (F.col("items_fetched") != F.coalesce("prev_items_fetched", F.lit(0))) | ~F.col("status").eqNullSafe("RUNNING")
    marked = series.withColumn("_moved", moved.cast("int")).drop("prev_source_total", "prev_items_fetched", "prev_ts")
    islands = running_sum(marked, ["run_no"], ["ts", "event_id"], F.col("_moved"), "island")
    flat = islands.filter("_moved = 0").groupBy("run_no", "island").agg(
        F.count("*").alias("polls"), F.min("ts").alias("stalled_from"), F.max("ts").alias("stalled_to"), *more)
    return flat.filter(F.col("polls") > longer_than)


def intervals(series: DataFrame, length: str = "5 minutes") -> DataFrame:
    """Arrival and fetch events per run and interval."""
    new = (F.col("source_total") > F.col("prev_source_total"))
    got = F.col("items_fetched") > F.coalesce("prev_items_fetched", F.lit(0))
    return series.groupBy("run_no", F.window("ts", length).alias("w")).agg(
        F.count_if(new).alias("new_arrivals"), F.count_if(got).alias("fetch_events")).select(
        "run_no", F.col("w.start").alias("interval_start"), "new_arrivals", "fetch_events")


def summary(series: DataFrame) -> DataFrame:
    """First and last totals, sums of arrivals and fetches, event counts, direction."""
    order = F.struct("ts", "event_id")
    new = F.greatest(F.lit(0), F.col("source_total") - F.col("prev_source_total"))
    got = F.greatest(F.lit(0), F.col("items_fetched") - F.coalesce("prev_items_fetched", F.lit(0)))
    ends = series.groupBy("run_no").agg(
        F.count("*").alias("total_reports"),
        F.min_by("items_fetched", order).alias("initial_items"), F.max_by("items_fetched", order).alias("final_items"),
        F.min_by("source_total", order).alias("initial_total"), F.max_by("source_total", order).alias("final_total"),
        F.count_if(F.col("prev_ts").isNotNull() & (new > 0)).alias("arrival_events"),
        F.count_if(got > 0).alias("fetch_events"),
        F.coalesce(F.sum(F.when(F.col("prev_ts").isNotNull(), new)), F.lit(0)).alias("arrived"),
        F.sum(got).alias("fetched"))
    change = F.signum(F.col("final_total") - F.col("initial_total"))
    return ends.withColumn("direction", F.when(change > 0, "up").when(change < 0, "down").otherwise("none"))
