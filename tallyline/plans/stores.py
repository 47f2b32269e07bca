"""Stored tables of the pipeline: verdict log, runs, batch events, checkpoints.

Validation writes its verdicts once; every report, publish and coverage job reads
the written table. ``store`` writes a table into the shared folder on first use
and reads it back afterwards, so later jobs prune columns and push filters down
to the files, and do not repeat the validation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators import monitor, publish, reports, validate, verdict_store
from tallyline.plans import fixtures
from tallyline.session import scratch_path, shuffles_removed
from tallyline.sinks.day_log import write_days
from tallyline.sources import feed

_paths: dict[tuple[str, str, str], str] = {}


def written(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """The tables that others are derived from, as far as this session has written them."""
    return {n: store(spark, sf_dir, n) for n in names if (spark.sparkContext.applicationId, sf_dir, n) in _paths}


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of the feed pages. Products and batch events are written first, so that the shuffles which make them are gone when
    the pages are put together; later tables are made from them too."""
    made = {n: store(spark, sf_dir, n) for n in ("products", "batch_events")}
    return fixtures.landed_pages(spark, sf_dir, **made).select("value")


def _build(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name == "verdicts":
        return validate.validate_json(fixtures.items(spark, sf_dir, **written(spark, sf_dir, "products")), [*fixtures.ITEM_KEYS, "raw"])
    if name == "run_list":  # the runs alone, for queries that look at no verdict
        return fixtures.table(spark, sf_dir, "runs", **written(spark, sf_dir, "products"))
    if name == "runs":
        return reports.with_counters(fixtures.table(spark, sf_dir, "runs", **written(spark, sf_dir, "products")), store(spark, sf_dir, "verdicts"))
    if name in ("polls", "fetch_polls"):
        events = fixtures.table(spark, sf_dir, "events").select(
            F.col("user_id").alias("run_no"), "event_id", "ts", F.floor("value").alias("source_total"),
            F.expr(fixtures.FETCH_STEPS if name == "polls" else fixtures.ALL_STEPS).cast("long").alias("step"),
            F.when((F.col("event_type") == "error") & (F.col("event_id") % 8 == 0), "PARTIAL_FAILED").otherwise("RUNNING").alias("status"))
        return monitor.polls(monitor.running_sum(events, ["run_no"], ["ts", "event_id"], F.col("step"), "items_fetched").drop("step"))
    if name == "landed_pages":
        return landed_pages(spark, sf_dir)
    if name == "page_ids":
        return feed.page_ids(store(spark, sf_dir, "landed_pages"))
    if name == "current":
        return verdict_store.latest(store(spark, sf_dir, "verdicts").drop("raw"))
    if name == "day_log":
        current = verdict_store.latest(store(spark, sf_dir, "verdicts").withColumn("n_keys", publish.top_level_keys()))
        return verdict_store.with_run_day(current, store(spark, sf_dir, "run_list"))
    if name == "current_days":
        return verdict_store.with_run_day(store(spark, sf_dir, "current"), store(spark, sf_dir, "run_list"))
    if name == "item_days":
        return fixtures.items(spark, sf_dir, **written(spark, sf_dir, "products"))
    if name == "checkpoints":
        text = fixtures.TEXTS["checkpoints"]
        return spark.sql(text, batch_events=store(spark, sf_dir, "batch_events"))
    return fixtures.table(spark, sf_dir, name, **(written(spark, sf_dir, "products") if name != "products" else {}))


# Tables partitioned by a day: the local day of the run, the day of the feed.
BY_DAY = {"current_days": "day", "item_days": "run_date"}


def path_of(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Where a stored table is; written on first use."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _paths:
        path = scratch_path(spark, name)
        rows = _build(spark, sf_dir, name)
        with shuffles_removed(spark):
            if name in BY_DAY:
                write_days(rows, path, BY_DAY[name])
            else:  # records and pages are repetitive texts, which take half the space of the default codec
                rows.write.option("compression", "zstd").parquet(path)
        _paths[key] = path
    return _paths[key]


def store(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(path_of(spark, sf_dir, name))
