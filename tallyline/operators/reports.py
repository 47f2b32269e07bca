"""Counts and reports over verdicts, runs and batch events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions import dates

# Coverage target of the cursor scan; moment the date filter changed.
ID_TARGET = 12_000
FILTER_CHANGE = "2026-02-20 10:00:00"

# Report column and the run column it shows, in report order.
RUN_REPORT = {
    "run_id": "run_id", "status": "status", "status_filter": "status_filter", "from": "from_date", "to": "to_date",
    "start_time": "start_time", "end_time": "end_time", "pages_fetched": "pages_fetched",
    "items_fetched": "items_fetched", "schema_invalid": "schema_invalid", "validated": "validated_count",
    "accepted": "accepted_count", "rejected": "rejected_count", "delivered": "delivered_count",
    "delivery_failed": "delivery_failed_count",
}


def reason_frequency(verdicts: DataFrame) -> DataFrame:
    """How often each rule rejects: the part of a reason before its first colon."""
    reason = verdicts.select(F.explode("reasons").alias("reason"))
    return reason.groupBy(F.substring_index("reason", ":", 1).alias("rule")).agg(F.count("*").alias("n"))


def key_profile(items: DataFrame, raw: str = "raw") -> DataFrame:
    """How many records carry each top-level key."""
    keys = items.select(F.explode(F.array_distinct(F.json_object_keys(raw))).alias("key"))
    return keys.groupBy("key").agg(F.count("*").alias("n"))


def distinct_by_page(items: DataFrame) -> DataFrame:
    ids = F.countDistinct("gtin")
    return items.agg(F.countDistinct("run_id", "batch_id").alias("pages"), ids.alias("unique_ids"),
                     (ids >= ID_TARGET).alias("reaches_target"))


def run_counters(verdicts: DataFrame, batch_events: DataFrame) -> DataFrame:
    """Per run: pages and items fetched, verdict counts. Records that fail the gate
    count as validated and schema-invalid, not as rejected. A hot run is counted
    in partial sums before the shuffle."""
    valid = F.col("schema_valid")
    checked = verdicts.groupBy("run_id").agg(
        F.count("*").alias("validated_count"),
        F.count_if(F.col("validation_status") == "Accepted").alias("accepted_count"),
        F.count_if(valid & (F.col("validation_status") == "Rejected")).alias("rejected_count"),
        F.count_if(~valid).alias("schema_invalid"),
    )
    fetched = batch_events.groupBy("run_id").agg(
        F.count("*").alias("pages_fetched"), F.sum("items_count").alias("items_fetched"))
    return fetched.join(checked, "run_id", "left").na.fill(0)


def with_counters(runs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Runs with their accepted, rejected and schema-invalid counts."""
    counts = verdicts.groupBy("run_id").agg(
        F.count_if(F.col("validation_status") == "Accepted").alias("accepted_count"),
        F.count_if(F.col("schema_valid") & (F.col("validation_status") == "Rejected")).alias("rejected_count"),
        F.count_if(~F.col("schema_valid")).alias("schema_invalid"),
    )
    return runs.join(counts, "run_id", "left").na.fill(0, ["accepted_count", "rejected_count", "schema_invalid"])


def run_results(verdicts: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Rows of a run's result file, and the columns ``keep``."""
    yes_no = {c: F.when(F.col(c), "Yes").otherwise("No").alias(c) for c in ("schema_valid", "business_valid")}
    stamp = F.concat(F.regexp_replace(F.col("created_at").cast("string"), " ", "T"), F.lit(".000Z"))
    return verdicts.select("run_id", "gtin", "validation_status", F.array_join("reasons", "; ").alias("reasons"),
                           yes_no["schema_valid"], yes_no["business_valid"],
                           F.coalesce(stamp, F.lit("")).alias("validated_at"), *keep)


def run_report(runs: DataFrame) -> DataFrame:
    return runs.select(*[F.col(src).alias(name) for name, src in RUN_REPORT.items()])


def daily_summary(runs: DataFrame, offset_minutes: int = 0) -> DataFrame:
    """One row per day of run start, in the zone the summary is kept in."""
    status = F.col("status")

    def total(column: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).alias(f"total_{column.removesuffix('_count')}")

    return runs.groupBy(dates.local_day(F.col("start_time"), offset_minutes).alias("report_date")).agg(
        F.count_if(status == "RUNNING").alias("runs_running"),
        F.count_if(status == "SUCCESS").alias("runs_success"),
        F.count_if(status.isin("FAILED", "PARTIAL_FAILED")).alias("runs_failed"),
        *[total(c) for c in ("items_fetched", "validated_count", "accepted_count", "rejected_count",
                             "delivered_count", "delivery_failed_count")],
    )


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.when(whole > 0, F.round(part * 100.0 / whole, digits)).otherwise(F.lit(0.0))


def run_rates(runs: DataFrame) -> DataFrame:
    items = F.col("items_fetched")
    return runs.select("run_id", percent(F.col("accepted_count"), items).alias("accepted_pct"),
                       percent(F.col("rejected_count"), items).alias("rejected_pct"),
                       percent(F.col("validated_count"), items).alias("progress_pct"))


def run_throughput(runs: DataFrame, now: Column) -> DataFrame:
    """Elapsed whole minutes and items per second (over at least one second)."""
    seconds = dates.second_diff(now, F.col("start_time"))
    rate = F.round(F.col("items_fetched") / F.greatest(F.lit(1), seconds), 6)
    return runs.select("run_id", dates.minute_diff(now, F.col("start_time")).alias("elapsed_minutes"),
                       F.when(F.col("items_fetched") > 0, rate).otherwise(0.0).alias("items_per_second"))


def run_duplicates(verdicts: DataFrame) -> DataFrame:
    """Records and distinct ids per run. Distinct counting spreads over (run, id)
    first, so one large run does not land in one task."""
    return verdicts.groupBy("run_id").agg(
        F.count("*").alias("total_records"), F.countDistinct("gtin").alias("unique_ids")
    ).withColumn("duplicates", F.col("total_records") - F.col("unique_ids"))


def top_duplicate_ids(verdicts: DataFrame, top: int = 10) -> DataFrame:
    """The most repeated ids of each run; ties go to the smaller id."""
    counts = verdicts.groupBy("run_id", "gtin").agg(F.count("*").alias("n")).filter("n > 1")
    w = Window.partitionBy("run_id").orderBy(F.desc("n"), "gtin")
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top)


def batch_event_stats(batch_events: DataFrame, event_type: str = "RAW_BATCH_ENQUEUED") -> DataFrame:
    return batch_events.filter(F.col("event_type") == event_type).groupBy("run_id").agg(
        F.count("*").alias("total_batches"), F.sum("items_count").alias("total_items_in_batches"),
        F.min("source_page_seq").alias("first_page"), F.max("source_page_seq").alias("last_page"))


def run_discrepancy(runs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Fetched items minus distinct ids, and the likely cause."""
    ids = run_duplicates(verdicts).select("run_id", "unique_ids")
    joined = runs.join(ids, "run_id", "left").na.fill(0, ["unique_ids"])
    diff = F.col("items_fetched") - F.col("unique_ids")
    before = F.col("start_time") < F.lit(FILTER_CHANGE).cast("timestamp_ntz")
    cause = (F.when((diff > 0) & before, "before date filter fix").when(diff > 0, "after date filter fix")
             .otherwise("no significant discrepancy"))
    return joined.select("run_id", "items_fetched", "unique_ids", diff.alias("discrepancy"),
                         F.when(diff > 0, F.round(diff * 100.0 / F.col("items_fetched"), 1)).alias("discrepancy_pct"),
                         cause.alias("cause"))


def day_run_totals(runs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Per local day: runs, items fetched, distinct ids of their verdicts."""
    days = runs.select("run_id", "items_fetched", dates.local_day(F.col("start_time")).alias("day"))
    totals = days.groupBy("day").agg(F.count("*").alias("n_runs"), F.sum("items_fetched").alias("total_fetched"))
    ids = verdicts.join(days.select("run_id", "day"), "run_id").groupBy("day").agg(
        F.countDistinct("gtin").alias("unique_ids"))
    return totals.join(ids, "day", "left").na.fill(0, ["unique_ids"])


def run_outcomes(runs: DataFrame, day: Column) -> DataFrame:
    status = F.col("status")
    return runs.groupBy(day.alias("day")).agg(
        F.count("*").alias("total_runs"), F.count_if(status == "SUCCESS").alias("successful"),
        F.count_if(status == "FAILED").alias("failed"), F.count_if(status == "PARTIAL_FAILED").alias("partial"),
        F.coalesce(F.sum("items_fetched"), F.lit(0)).alias("total_items"))


def continuity(days: DataFrame, fresh_minutes: int = 60) -> DataFrame:
    """Whether validation goes on by itself: days of (total_runs, newest, now, grew). A day whose source grew works if it has
    several runs, or one that started less than ``fresh_minutes`` ago."""
    grew, n = F.coalesce("grew", F.lit(False)), F.col("total_runs")
    age = dates.minute_diff(F.col("now"), F.col("newest"))
    return days.withColumn("verdict", F.when(grew & ((n > 1) | (age < fresh_minutes)), "working").when(
        grew & (n == 1), "single run").otherwise("insufficient data"))


def pipeline_totals(runs: DataFrame, outbox: DataFrame) -> DataFrame:
    """Totals over everything: one row of counters plus delivery retries."""
    names = {"pages_fetched": "pages", "items_fetched": "items", "validated_count": "validated",
             "accepted_count": "accepted", "rejected_count": "rejected", "delivered_count": "delivered",
             "delivery_failed_count": "delivery_failed"}
    totals = runs.agg(*[F.sum(c).alias(n) for c, n in names.items()])
    retries = outbox.agg(F.sum(F.col("attempts") - 1).alias("delivery_retries"))
    metrics = lambda df: df.select(F.expr(  # noqa: E731 - one row to (metric, total) rows
        "stack({}, {}) AS (metric, total)".format(len(df.columns), ", ".join(f"'{c}', {c}" for c in df.columns))))
    return metrics(totals).unionByName(metrics(retries))
