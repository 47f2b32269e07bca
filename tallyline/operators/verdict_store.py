"""Current verdict per product id, and joins of verdicts with runs and ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions import dates


def latest(verdicts: DataFrame, key: str = "gtin") -> DataFrame:
    """Last verdict written per id; within one batch the later item wins.

    ``row_number = 1`` lets Spark keep one row per id in every map task before the
    shuffle, so an id (blank ones, say) holding a third of all rows arrives as
    one row per task.
    """
    w = Window.partitionBy(key).orderBy(F.desc("created_at"), F.desc("batch_id"), F.desc("item_pos"))
    return verdicts.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def upsert(current: DataFrame, arrived: DataFrame, key: str = "gtin") -> DataFrame:
    """The current view after a batch of new verdicts."""
    return latest(current.unionByName(arrived.select(current.columns)), key)


def with_run_day(verdicts: DataFrame, runs: DataFrame, offset_minutes: int = dates.IST_MINUTES) -> DataFrame:
    """Verdicts with the local day their run started. The join carries two narrow
    run columns; Spark broadcasts them when they are small and otherwise joins by
    shuffle, splitting hot runs at run time."""
    days = runs.select("run_id", dates.local_day(F.col("start_time"), offset_minutes).alias("day"))
    return verdicts.join(days, "run_id")


# Days of a bin of the interval join.
BIN = 32


def runs_on_days(runs: DataFrame, days: DataFrame, bin_days: int = BIN) -> DataFrame:
    """(run_id, day) of every ``day`` of ``days`` within the inclusive window of a run. Both sides meet in bins of days: a
    window has one row for each bin it reaches into, not for each of its days."""
    number = lambda c: F.unix_date(c)
    wide = runs.where("from_date <= to_date").select("run_id", "from_date", "to_date", F.explode(F.sequence(
        F.floor(number("from_date") / bin_days), F.floor(number("to_date") / bin_days))).alias("bin"))
    asked = days.select("day").distinct().withColumn("bin", F.floor(number("day") / bin_days))
    return wide.join(asked, "bin").where("day BETWEEN from_date AND to_date").select("run_id", "day")


def in_run_window(verdicts: DataFrame, runs: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """Verdicts with an id under every day of ``days`` (column ``day``) that the window of their run holds; without ``days``
    under every day of the window. The window travels as two dates and is spread after the join, so long windows
    multiply the result and not the shuffle."""
    named = verdicts.filter(F.col("gtin") != "")
    if days is None:
        spread = named.join(runs.select("run_id", "from_date", "to_date"), "run_id").where("from_date <= to_date")
        return spread.withColumn("day", F.explode(F.sequence("from_date", "to_date"))).drop("from_date", "to_date")
    held = runs_on_days(runs, days).groupBy("run_id").agg(F.sort_array(F.collect_list("day")).alias("days"))
    return named.join(held, "run_id").withColumn("day", F.explode("days")).drop("days")


def on_day(runs: DataFrame, day: str | Column) -> DataFrame:
    """Runs whose window holds a day."""
    return runs.where((F.lit(day) if isinstance(day, str) else day).cast("date").between(F.col("from_date"), F.col("to_date")))


def first_stored(verdicts: DataFrame, runs: DataFrame) -> DataFrame:
    """When each id first had a verdict: the start of the earliest run that wrote one."""
    return verdicts.filter(F.trim("gtin") != "").join(runs.select("run_id", "start_time"), "run_id").groupBy("gtin").agg(
        F.min("start_time").alias("stored_at"))


def _known(items: DataFrame, first: DataFrame) -> DataFrame:
    """Items of (gtin, started, ...) with ``known``: the id had a verdict before the run of the item started. Items without
    an id are never known; they stay out of the join, where they would form one hot key."""
    named = items.filter(F.col("gtin").isNotNull()).join(first, "gtin", "left")
    named = named.withColumn("known", F.coalesce(F.col("stored_at") < F.col("started"), F.lit(False))).drop("stored_at")
    return named.unionByName(items.filter(F.col("gtin").isNull()).withColumn("known", F.lit(False)))


def new_items(items: DataFrame, first: DataFrame) -> DataFrame:
    """Items that a run has to validate: those without an id, and those whose id had no verdict when the run started."""
    return _known(items, first).filter("NOT known").drop("known")


def backfill_totals(items: DataFrame, first: DataFrame) -> DataFrame:
    """Per run: pages, items, items to validate, items skipped as known."""
    return _known(items, first).groupBy("run_id").agg(
        F.countDistinct("batch_id").alias("total_pages"), F.count("*").alias("total_items"),
        F.count_if(~F.col("known")).alias("total_enqueued"), F.count_if("known").alias("total_skipped"))


def existing_ids(items: DataFrame, first: DataFrame) -> DataFrame:
    """(run_id, gtin): the different ids on a run's pages that had a verdict when it started."""
    return _known(items, first).filter("known").select("run_id", "gtin").distinct()
