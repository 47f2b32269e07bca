"""Queries on stored tables: runs, reports, coverage, delivery, monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions import dates
from tallyline.operators import coverage, delivery, monitor, reports, runs, verdict_store
from tallyline.plans import fixtures
from tallyline.plans.oracle import query
from tallyline.plans.registry import register
from tallyline.plans.stores import path_of, store
from tallyline.session import scratch_path
from tallyline.sinks import outputs
from tallyline.sinks.day_log import read_days
from tallyline.sources import feed, id_list

REASON_TEXT = "array_join(reasons, '; ') AS reasons"


def text(column: str):
    return F.col(column).cast("string").alias(column)


def ntz(value: str):
    return F.lit(value).cast("timestamp_ntz")


def tables(spark, sf_dir, *names: str) -> list[DataFrame]:
    return [store(spark, sf_dir, n) for n in names]


# ---- verdict store

@register("upsert_latest_verdict", query("""
SELECT vgtin AS gtin, run_id, batch_id, item_pos, validation_status, reason_text AS reasons FROM current""", "current"))
def upsert_latest_verdict(spark, sf_dir):
    log = store(spark, sf_dir, "verdicts").drop("raw")
    return verdict_store.latest(log).select("gtin", "run_id", "batch_id", "item_pos", "validation_status", F.expr(REASON_TEXT))


def current(spark, sf_dir) -> DataFrame:
    return store(spark, sf_dir, "current")


@register("verdicts_for_day", query("""
SELECT ist_day AS day, vgtin AS gtin, validation_status, reason_text AS reasons
FROM current JOIN run_days USING (run_id)""", "current", "run_days"))
def verdicts_for_day(spark, sf_dir):
    rows = verdict_store.with_run_day(current(spark, sf_dir), store(spark, sf_dir, "run_list"))
    return rows.orderBy("day", "created_at").select("day", "gtin", "validation_status", F.expr(REASON_TEXT))


def day_verdicts(spark, sf_dir, day: str) -> DataFrame:
    """The current verdicts of one local day, from the table by day."""
    return read_days(spark, path_of(spark, sf_dir, "current_days"), day, day)


@register("verdicts_for_last_day", query("""
SELECT ist_day AS day, vgtin AS gtin, validation_status, reason_text AS reasons FROM current JOIN run_days USING (run_id)
WHERE ist_day=(SELECT max(ist_day) FROM current JOIN run_days USING (run_id))""", "current", "run_days"))
def verdicts_for_last_day(spark, sf_dir):
    """The day comes from the data, so the scan of the verdicts is pruned when the day is known."""
    rows = store(spark, sf_dir, "current_days")
    last = rows.groupBy().agg(F.max("day").alias("last"))
    return rows.where(F.col("day") == last.scalar()).select("day", "gtin", "validation_status", F.expr(REASON_TEXT))


@register("verdict_count_by_day", query("""
SELECT ist_day AS day, count(*) AS n FROM current JOIN run_days USING (run_id) GROUP BY 1""", "current", "run_days"))
def verdict_count_by_day(spark, sf_dir):
    rows, r = current(spark, sf_dir), store(spark, sf_dir, "run_list")
    return verdict_store.with_run_day(rows, r).groupBy("day").agg(F.count("*").alias("n"))


@register("verdicts_in_run_window", query("""
SELECT CAST(unnest(generate_series(CAST(from_date AS TIMESTAMP), CAST(to_date AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE)
  AS day, vgtin AS gtin, run_id, validation_status FROM current JOIN runs USING (run_id) WHERE vgtin<>''""",
                                          "current", "runs"))
def verdicts_in_run_window(spark, sf_dir):
    rows = verdict_store.in_run_window(current(spark, sf_dir), store(spark, sf_dir, "run_list"))
    return rows.select("day", "gtin", "run_id", "validation_status")


@register("verdicts_on_days", query("""
SELECT r.from_date AS day, count(*) AS n, count(DISTINCT vgtin) AS ids FROM (SELECT DISTINCT from_date FROM runs WHERE d=1) r
JOIN runs w ON r.from_date BETWEEN w.from_date AND w.to_date JOIN current c ON c.run_id=w.run_id WHERE vgtin<>'' GROUP BY 1""", "current", "runs"))
def verdicts_on_days(spark, sf_dir):
    """Counts for the first day of each month, whatever the windows of the runs."""
    r = store(spark, sf_dir, "run_list")
    days = r.where(F.dayofmonth("from_date") == 1).select(F.col("from_date").alias("day"))
    rows = verdict_store.in_run_window(current(spark, sf_dir), r, days)
    return rows.groupBy("day").agg(F.count("*").alias("n"), F.countDistinct("gtin").alias("ids"))


def _page_items(spark, sf_dir) -> DataFrame:
    """Ids decoded from the landed pages, with the start of the run that fetched them."""
    ids = store(spark, sf_dir, "page_ids")
    started = store(spark, sf_dir, "run_list").select("run_id", F.col("start_time").alias("started"))
    return ids.join(started, "run_id")


def _first_stored(spark, sf_dir) -> DataFrame:
    return verdict_store.first_stored(*tables(spark, sf_dir, "verdicts", "run_list"))


_KNOWN = """(SELECT p.run_id, p.batch_id, trim(p.gtin) AS gtin, CAST(row_number() OVER (PARTITION BY p.run_id, p.batch_id
  ORDER BY p.item_pos) AS INT) AS item_pos, coalesce(trim(p.gtin)<>'' AND f.stored_at < r.start_time, false) AS known
  FROM products p JOIN runs r USING (run_id) LEFT JOIN (SELECT vgtin, min(start_time) AS stored_at FROM verdicts JOIN runs USING (run_id)
  WHERE trim(vgtin)<>'' GROUP BY 1) f ON f.vgtin=trim(p.gtin))"""


@register("backfill_new_items", query(f"SELECT run_id, batch_id, item_pos FROM {_KNOWN} WHERE NOT known", "products", "runs", "verdicts"))
def backfill_new_items(spark, sf_dir):
    return verdict_store.new_items(_page_items(spark, sf_dir), _first_stored(spark, sf_dir)).select("run_id", "batch_id", "item_pos")


@register("backfill_totals", query(f"""
SELECT run_id, count(DISTINCT batch_id) AS total_pages, count(*) AS total_items, count(*) FILTER (WHERE NOT known) AS total_enqueued,
  count(*) FILTER (WHERE known) AS total_skipped FROM {_KNOWN} GROUP BY run_id""", "products", "runs", "verdicts"))
def backfill_totals(spark, sf_dir):
    return verdict_store.backfill_totals(_page_items(spark, sf_dir), _first_stored(spark, sf_dir))


@register("existing_ids", query(f"SELECT DISTINCT run_id, gtin FROM {_KNOWN} WHERE known", "products", "runs", "verdicts"))
def existing_ids(spark, sf_dir):
    return verdict_store.existing_ids(_page_items(spark, sf_dir), _first_stored(spark, sf_dir))


# ---- runs

@register("run_counters", query("""
SELECT c.run_id, validated AS validated_count, accepted_count, rejected_count, schema_invalid,
  b.pages AS pages_fetched, b.items AS items_fetched
FROM counters c JOIN (SELECT run_id, count(*) AS pages, CAST(sum(items_count) AS BIGINT) AS items FROM batch_events
GROUP BY run_id) b USING (run_id)""", "counters", "batch_events"))
def run_counters(spark, sf_dir):
    return reports.run_counters(*tables(spark, sf_dir, "verdicts", "batch_events"))


@register("checkpoint_latest", query("""
SELECT run_id, source_page_seq, cursor_in, cursor_out FROM (SELECT *, row_number() OVER (PARTITION BY run_id
  ORDER BY source_page_seq DESC) AS rn FROM batch_events) WHERE rn=1""", "batch_events"))
def checkpoint_latest(spark, sf_dir):
    return runs.checkpoint_latest(store(spark, sf_dir, "batch_events")).withColumn(
        "source_page_seq", F.col("source_page_seq").cast("long"))


@register("checkpoint_or_last_batch", query("""
SELECT run_id, CAST(coalesce(c.source_page_seq, b.source_page_seq) AS BIGINT) AS source_page_seq,
  CASE WHEN c.run_id IS NULL THEN b.cursor_in ELSE c.cursor_in END AS cursor_in,
  CASE WHEN c.run_id IS NULL THEN b.cursor_out ELSE c.cursor_out END AS cursor_out
FROM (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY source_page_seq DESC) AS rn FROM batch_events) b
LEFT JOIN checkpoints c USING (run_id) WHERE rn=1""", "batch_events", "checkpoints"))
def checkpoint_or_last_batch(spark, sf_dir):
    out = runs.checkpoint_or_last_batch(*tables(spark, sf_dir, "run_list", "checkpoints", "batch_events"))
    return out.withColumn("source_page_seq", F.col("source_page_seq").cast("long"))


@register("resumable_run", query("SELECT from_date, run_id, cursor_out FROM resumable", "resumable"))
def resumable_run(spark, sf_dir):
    return runs.resumable_run(*tables(spark, sf_dir, "run_list", "checkpoints", "batch_events")).select(
        "from_date", "run_id", "cursor_out")


@register("last_cursor_for_day", query("""
SELECT from_date, run_id, cursor_out FROM (SELECT *, row_number() OVER (PARTITION BY from_date
  ORDER BY src, start_time DESC, run_id DESC, source_page_seq DESC) AS rn FROM day_cursor
  WHERE items_fetched>0 AND NOT coalesce(ingestion_completed,false)) WHERE rn=1""", "day_cursor"))
def last_cursor_for_day(spark, sf_dir):
    return runs.last_cursor_for_day(*tables(spark, sf_dir, "run_list", "checkpoints", "batch_events")).select(
        "from_date", "run_id", "cursor_out")


@register("latest_completed_run", query("""
SELECT day, run_id FROM (SELECT ist_day AS day, run_id, row_number() OVER (PARTITION BY ist_day
  ORDER BY end_time DESC NULLS LAST, start_time DESC, run_id DESC) AS rn FROM run_days
  WHERE status IN ('SUCCESS','PARTIAL_FAILED')) WHERE rn=1""", "run_days"))
def latest_completed_run(spark, sf_dir):
    return runs.latest_completed(store(spark, sf_dir, "run_list")).select("day", "run_id")


@register("latest_runs", query("""
SELECT run_id, status, items_fetched FROM runs ORDER BY start_time DESC, run_id DESC LIMIT 10""", "runs"))
def latest_runs(spark, sf_dir):
    return store(spark, sf_dir, "run_list").orderBy(F.desc("start_time"), F.desc("run_id")).limit(10).select(
        "run_id", "status", "items_fetched")


@register("latest_terminal_run", query("""
SELECT from_date, run_id, status FROM (SELECT *, row_number() OVER (PARTITION BY from_date ORDER BY start_time DESC,
  run_id DESC) AS rn FROM runs WHERE status IN ('SUCCESS','PARTIAL_FAILED','FAILED')) WHERE rn=1""", "runs"))
def latest_terminal_run(spark, sf_dir):
    return runs.latest_terminal(store(spark, sf_dir, "run_list")).select("from_date", "run_id", "status")


def _noon(day: str = "from_date"):
    """The moment each day is looked at: 09:50 of the day itself."""
    return F.col(day).cast("timestamp_ntz") + dates.minutes(590)


_ACTIVE = """SELECT from_date, run_id FROM (SELECT *, row_number() OVER (PARTITION BY from_date ORDER BY start_time DESC,
  run_id DESC) AS rn FROM runs WHERE status IN ('RUNNING','PARTIAL_FAILED')
  AND start_time > CAST(from_date AS TIMESTAMP) + INTERVAL 560 MINUTE
  AND start_time <= CAST(from_date AS TIMESTAMP) + INTERVAL 590 MINUTE) WHERE rn=1"""


@register("active_run", query(_ACTIVE, "runs"))
def active_run(spark, sf_dir):
    return runs.active_run(store(spark, sf_dir, "run_list"), _noon()).select("from_date", "run_id")


@register("next_run_action", query(f"""
SELECT d.from_date, CASE WHEN r.run_id IS NOT NULL THEN 'resume' WHEN a.run_id IS NOT NULL THEN 'skip-active'
  WHEN t.status='SUCCESS' AND t.age<5 THEN 'skip-recent' ELSE 'start' END AS action, coalesce(r.run_id,a.run_id) AS run_id
FROM (SELECT DISTINCT from_date FROM runs) d LEFT JOIN resumable r USING (from_date)
LEFT JOIN ({_ACTIVE}) a USING (from_date)
LEFT JOIN (SELECT from_date, status, floor(date_diff('second', start_time,
  CAST(from_date AS TIMESTAMP)+INTERVAL 590 MINUTE)/60) AS age FROM (SELECT *, row_number() OVER (PARTITION BY from_date
  ORDER BY start_time DESC, run_id DESC) AS rn FROM runs WHERE status IN ('SUCCESS','PARTIAL_FAILED','FAILED'))
  WHERE rn=1) t USING (from_date)""", "runs", "resumable"))
def next_run_action(spark, sf_dir):
    return runs.next_action(*tables(spark, sf_dir, "run_list", "checkpoints", "batch_events"), _noon())


NOW = "2002-01-01 00:00:00"


@register("finalize_runs", query(f"""
SELECT run_id, CASE WHEN done THEN 'SUCCESS' ELSE status END AS status,
  CAST(CASE WHEN done THEN TIMESTAMP '{NOW}' ELSE end_time END AS VARCHAR) AS end_time
FROM (SELECT *, status='RUNNING' AND ingestion_completed AND validated_count=items_fetched AS done FROM runs)""", "runs"))
def finalize_runs(spark, sf_dir):
    return runs.finalize(store(spark, sf_dir, "run_list"), ntz(NOW)).select("run_id", "status", text("end_time"))


@register("catch_up_status", query("""
SELECT run_id, remaining, CASE WHEN remaining>0 AND status='RUNNING' AND NOT ingestion_completed THEN 'ACTIVE'
  WHEN remaining>0 AND status='RUNNING' THEN 'INGESTION DONE, ITEMS REMAIN'
  WHEN remaining>0 AND status='SUCCESS' THEN 'COMPLETED, NEW ITEMS' WHEN remaining>0 THEN 'NO STATUS'
  ELSE 'ALL FETCHED' END AS state,
  CASE WHEN status='RUNNING' AND NOT ingestion_completed THEN 'check again'
  WHEN status='RUNNING' AND remaining>0 THEN 'resume or start a run' WHEN status='RUNNING' THEN 'validating'
  WHEN status='SUCCESS' AND remaining>0 THEN 'start a run' WHEN status='SUCCESS' THEN 'up to date' END AS advice
FROM (SELECT *, greatest(0, items_fetched + d - 15 - items_fetched) AS remaining FROM runs)""", "runs"))
def catch_up_status(spark, sf_dir):
    # The source total drifts with the day of month around what the run fetched.
    total = F.col("items_fetched") + F.col("d") - 15
    return runs.catch_up_status(store(spark, sf_dir, "run_list"), total)


@register("run_health", query("""
SELECT day, l.run_id, CASE WHEN status IN ('RUNNING','PARTIAL_FAILED') AND items_fetched=0 THEN 'ingestion failed'
  WHEN status='RUNNING' AND validated_count=0 AND items_fetched>0 THEN 'validation pending'
  WHEN coalesce(n,0)>0 THEN 'ready to publish' ELSE 'none' END AS advice
FROM (SELECT *, ist_day AS day, row_number() OVER (PARTITION BY ist_day ORDER BY start_time DESC, run_id DESC) AS rn
  FROM run_days) l LEFT JOIN (SELECT ist_day AS day, count(*) AS n FROM current JOIN run_days USING (run_id) GROUP BY 1)
  USING (day) WHERE l.rn=1""", "current", "run_days"))
def run_health(spark, sf_dir):
    rows, r = current(spark, sf_dir), store(spark, sf_dir, "run_list")
    days = r.withColumn("day", dates.local_day(F.col("start_time")))
    latest = runs._top(days, ["day"], F.desc("start_time"), F.desc("run_id"))
    counts = verdict_store.with_run_day(rows, r).groupBy("day").agg(F.count("*").alias("n_verdicts"))
    return runs.run_health(latest, counts)


# ---- reports

@register("run_results_export", query("""
SELECT run_id, vgtin AS gtin, validation_status, reason_text AS reasons, CASE WHEN schema_valid THEN 'Yes' ELSE 'No' END
  AS schema_valid, CASE WHEN business_valid THEN 'Yes' ELSE 'No' END AS business_valid,
  strftime(created_at, '%Y-%m-%dT%H:%M:%S.000Z') AS validated_at FROM current""", "current"))
def run_results_export(spark, sf_dir):
    return reports.run_results(current(spark, sf_dir))


_REPORT = """
SELECT run_id, status, status_filter, from_date AS "from", CAST(to_date AS DATE) AS "to",
  CAST(start_time AS VARCHAR) AS start_time, CAST(end_time AS VARCHAR) AS end_time, pages_fetched, items_fetched,
  schema_invalid, validated_count AS validated, accepted_count AS accepted, rejected_count AS rejected,
  delivered_count AS delivered, delivery_failed_count AS delivery_failed FROM runs_full"""


@register("run_report", query(_REPORT, "runs_full"))
def run_report(spark, sf_dir):
    report = reports.run_report(store(spark, sf_dir, "runs"))
    return report.withColumns({c: F.col(c).cast("string") for c in ("start_time", "end_time")})


_SUMMARY = """
SELECT CAST(start_time AS DATE) AS report_date, count(*) FILTER (WHERE status='RUNNING') AS runs_running,
  count(*) FILTER (WHERE status='SUCCESS') AS runs_success,
  count(*) FILTER (WHERE status IN ('FAILED','PARTIAL_FAILED')) AS runs_failed,
  CAST(sum(items_fetched) AS BIGINT) AS total_items_fetched, CAST(sum(validated_count) AS BIGINT) AS total_validated,
  CAST(sum(accepted_count) AS BIGINT) AS total_accepted, CAST(sum(rejected_count) AS BIGINT) AS total_rejected,
  CAST(sum(delivered_count) AS BIGINT) AS total_delivered,
  CAST(sum(delivery_failed_count) AS BIGINT) AS total_delivery_failed FROM runs_full GROUP BY 1"""


@register("daily_summary", query(_SUMMARY, "runs_full"))
def daily_summary(spark, sf_dir):
    return reports.daily_summary(store(spark, sf_dir, "runs"))


def _csv_sql(*columns: str) -> str:
    """A CSV line of text columns, quoted where needed."""
    field = """CASE WHEN regexp_matches({c}, '[",\n\r]') THEN '"'||replace({c},'"','""')||'"' ELSE {c} END"""
    return "||','||".join(field.format(c=f"coalesce(CAST({c} AS VARCHAR),'')") for c in columns)


_RESULT_FILE = ["gtin", "validation_status", "reasons", "schema_valid", "business_valid", "validated_at"]


@register("run_results_file", query(f"""
SELECT run_id, row_number() OVER (PARTITION BY run_id ORDER BY validated_at, batch_id, item_pos) AS line_no,
  {_csv_sql(*_RESULT_FILE)} AS line FROM (SELECT run_id, batch_id, item_pos, vgtin AS gtin, validation_status, reason_text AS reasons,
  CASE WHEN schema_valid THEN 'Yes' ELSE 'No' END AS schema_valid, CASE WHEN business_valid THEN 'Yes' ELSE 'No' END AS business_valid,
  strftime(created_at, '%Y-%m-%dT%H:%M:%S.000Z') AS validated_at FROM current)
UNION ALL SELECT DISTINCT run_id, 0, '{",".join(_RESULT_FILE)}' FROM current""", "current"))
def run_results_file(spark, sf_dir):
    """The result file of each run, in the order of validation, read back as it stands."""
    path = scratch_path(spark, "run-results")
    rows = reports.run_results(current(spark, sf_dir), ["batch_id", "item_pos"])
    outputs.write_csv(rows, path, ["run_id"], ["validated_at", "batch_id", "item_pos"], _RESULT_FILE)
    return outputs.read_lines(spark, path, ["run_id"]).withColumn("line_no", F.col("line_no").cast("long"))


_REPORT_FILE = list(reports.RUN_REPORT)


def _month_file(columns: list[str], rows: str, month: str, order: str) -> str:
    return f"""SELECT month, row_number() OVER (PARTITION BY month ORDER BY {order}) AS line_no,
  {_csv_sql(*[f'"{c}"' for c in columns])} AS line FROM (SELECT *, substr(CAST({month} AS VARCHAR),1,7) AS month FROM ({rows}))
UNION ALL SELECT DISTINCT substr(CAST({month} AS VARCHAR),1,7), 0, '{",".join(columns)}' FROM ({rows})"""


@register("run_report_file", query(_month_file(_REPORT_FILE, _REPORT, '"from"', "run_id"), "runs_full"))
def run_report_file(spark, sf_dir):
    """The reports of the runs of each month as JSON, read back and written as CSV in the order of the runs."""
    path, json_path = scratch_path(spark, "run-report"), scratch_path(spark, "run-report-json")
    report = reports.run_report(store(spark, sf_dir, "runs"))
    report = report.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in report.columns])
    month = F.substring("from", 1, 7)
    outputs.write_json(report.withColumn("month", month), json_path, ["month"], _REPORT_FILE)
    back = spark.read.schema(", ".join(f"`{c}` string" for c in _REPORT_FILE)).json(json_path).withColumn("month", month)
    outputs.write_csv(back, path, ["month"], ["run_id"], _REPORT_FILE)
    return outputs.read_lines(spark, path, ["month"]).withColumn("line_no", F.col("line_no").cast("long"))


_SUMMARY_FILE = ["report_date", "runs_running", "runs_success", "runs_failed", "total_items_fetched", "total_validated", "total_accepted",
                 "total_rejected", "total_delivered", "total_delivery_failed"]


@register("daily_summary_file", query(_month_file(_SUMMARY_FILE, _SUMMARY, "report_date", "report_date"), "runs_full"))
def daily_summary_file(spark, sf_dir):
    """The summaries of the days of each month as a CSV file, read back as it stands."""
    path = scratch_path(spark, "daily-summary")
    rows = reports.daily_summary(store(spark, sf_dir, "runs"))
    month = F.substring(F.col("report_date").cast("string"), 1, 7)
    outputs.write_csv(rows.withColumn("month", month), path, ["month"], ["report_date"], _SUMMARY_FILE)
    return outputs.read_lines(spark, path, ["month"]).withColumn("line_no", F.col("line_no").cast("long"))


@register("run_rates", query("""
SELECT run_id, round(accepted_count*100.0/items_fetched,1) AS accepted_pct,
  round(rejected_count*100.0/items_fetched,1) AS rejected_pct, round(validated_count*100.0/items_fetched,1) AS progress_pct
FROM runs_full""", "runs_full"))
def run_rates(spark, sf_dir):
    return reports.run_rates(store(spark, sf_dir, "runs"))


@register("run_throughput", query(f"""
SELECT run_id, CAST(floor(s/60) AS BIGINT) AS elapsed_minutes, round(items_fetched/greatest(1,s),6) AS items_per_second
FROM (SELECT *, date_diff('second', start_time, TIMESTAMP '{NOW}') AS s FROM runs)""", "runs"))
def run_throughput(spark, sf_dir):
    return reports.run_throughput(store(spark, sf_dir, "run_list"), ntz(NOW))


@register("run_duplicates", query("""
SELECT run_id, count(*) AS total_records, count(DISTINCT vgtin) AS unique_ids, count(*)-count(DISTINCT vgtin) AS duplicates
FROM verdicts GROUP BY run_id""", "verdicts"))
def run_duplicates(spark, sf_dir):
    return reports.run_duplicates(store(spark, sf_dir, "verdicts"))


@register("top_duplicate_ids", query("""
SELECT * FROM (SELECT run_id, vgtin AS gtin, count(*) AS n, CAST(row_number() OVER (PARTITION BY run_id
  ORDER BY count(*) DESC, vgtin) AS INT) AS rank FROM verdicts GROUP BY run_id, vgtin HAVING count(*)>1) WHERE rank<=10""",
                                     "verdicts"))
def top_duplicate_ids(spark, sf_dir):
    return reports.top_duplicate_ids(store(spark, sf_dir, "verdicts"))


@register("batch_event_stats", query("""
SELECT run_id, count(*) AS total_batches, CAST(sum(items_count) AS BIGINT) AS total_items_in_batches,
  min(source_page_seq) AS first_page, max(source_page_seq) AS last_page FROM batch_events
WHERE event_type='RAW_BATCH_ENQUEUED' GROUP BY run_id""", "batch_events"))
def batch_event_stats(spark, sf_dir):
    stats = reports.batch_event_stats(store(spark, sf_dir, "batch_events"))
    return stats.withColumns({c: F.col(c).cast("long") for c in ("first_page", "last_page")})


@register("page_event_log", query("""
SELECT run_id, count(*) AS total_batches, CAST(sum(items_count) AS BIGINT) AS total_items_in_batches,
  min(source_page_seq) AS first_page, max(source_page_seq) AS last_page FROM batch_events GROUP BY run_id""", "batch_events"))
def page_event_log(spark, sf_dir):
    """Events of the landed pages, appended by two jobs, the second of which begins with a page of the first."""
    path = scratch_path(spark, "batch-events")
    events = feed.page_events(store(spark, sf_dir, "landed_pages"))
    odd = F.col("source_page_seq") % 2 == 1
    runs.append_events(events.where(odd), path)
    runs.append_events(events.where(~odd | (F.col("source_page_seq") == 1)), path)
    return reports.batch_event_stats(spark.read.parquet(path))


@register("run_discrepancy", query("""
SELECT run_id, items_fetched, u AS unique_ids, items_fetched-u AS discrepancy,
  CASE WHEN items_fetched>u THEN round((items_fetched-u)*100.0/items_fetched,1) END AS discrepancy_pct,
  CASE WHEN items_fetched>u AND start_time < TIMESTAMP '2026-02-20 10:00:00' THEN 'before date filter fix'
  WHEN items_fetched>u THEN 'after date filter fix' ELSE 'no significant discrepancy' END AS cause
FROM runs JOIN (SELECT run_id, count(DISTINCT vgtin) AS u FROM verdicts GROUP BY run_id) USING (run_id)""",
                                   "runs", "verdicts"))
def run_discrepancy(spark, sf_dir):
    return reports.run_discrepancy(*tables(spark, sf_dir, "run_list", "verdicts"))


@register("day_run_totals", query("""
SELECT day, n_runs, total_fetched, coalesce(unique_ids, 0) AS unique_ids FROM (SELECT ist_day AS day, count(*) AS n_runs,
  CAST(sum(items_fetched) AS BIGINT) AS total_fetched FROM run_days GROUP BY 1) LEFT JOIN (SELECT ist_day AS day,
  count(DISTINCT vgtin) AS unique_ids FROM current JOIN run_days USING (run_id) GROUP BY 1) USING (day)""",
                                  "current", "run_days"))
def day_run_totals(spark, sf_dir):
    return reports.day_run_totals(store(spark, sf_dir, "run_list"), current(spark, sf_dir))


_OUTCOMES = """SELECT from_date AS day, count(*) AS total_runs, count(*) FILTER (WHERE status='SUCCESS') AS successful,
  count(*) FILTER (WHERE status='FAILED') AS failed, count(*) FILTER (WHERE status='PARTIAL_FAILED') AS partial,
  CAST(sum(items_fetched) AS BIGINT) AS total_items FROM runs GROUP BY 1"""


@register("run_outcomes", query(_OUTCOMES, "runs"))
def run_outcomes(spark, sf_dir):
    return reports.run_outcomes(store(spark, sf_dir, "run_list"), F.col("from_date"))


# The polls are of other years than the runs: their days are taken in turn as the days of the runs.
@register("continuity_verdict", query(f"""
SELECT day, CASE WHEN grew AND (total_runs>1 OR age<60) THEN 'working' WHEN grew AND total_runs=1 THEN 'single run'
  ELSE 'insufficient data' END AS verdict FROM (SELECT o.day, total_runs, coalesce(g.grew,false) AS grew,
  floor(date_diff('second', newest, CAST(o.day AS TIMESTAMP)+INTERVAL 590 MINUTE)/60) AS age
  FROM (SELECT *, dense_rank() OVER (ORDER BY day) AS k FROM ({_OUTCOMES})) o
  JOIN (SELECT from_date AS day, max(start_time) AS newest FROM runs GROUP BY 1) n ON n.day=o.day
  LEFT JOIN (SELECT dense_rank() OVER (ORDER BY CAST(ts AS DATE)) AS k, bool_or(source_total>p_total) AS grew FROM polls
  GROUP BY CAST(ts AS DATE)) g ON g.k=o.k)""", "runs", "polls"))
def continuity_verdict(spark, sf_dir):
    r, day = store(spark, sf_dir, "run_list"), F.col("from_date")
    newest = r.groupBy(day.alias("day")).agg(F.max("start_time").alias("newest"))
    days = reports.run_outcomes(r, day).join(newest, "day").withColumn("now", _noon("day"))
    grown = _polls(spark, sf_dir).groupBy(F.col("ts").cast("date").alias("poll_day")).agg(
        F.bool_or(F.col("source_total") > F.col("prev_source_total")).alias("grew"))
    # One row for each day on both sides.
    grown = grown.select(F.dense_rank().over(Window.orderBy("poll_day")).alias("k"), "grew")
    days = days.withColumn("k", F.dense_rank().over(Window.orderBy("day"))).join(grown, "k", "left")
    return reports.continuity(days).select("day", "verdict")


@register("pipeline_totals", query("""
SELECT * FROM (SELECT unnest(['pages','items','validated','accepted','rejected','delivered','delivery_failed']) AS metric,
  CAST(unnest([sum(pages_fetched),sum(items_fetched),sum(validated_count),sum(accepted_count),sum(rejected_count),
  sum(delivered_count),sum(delivery_failed_count)]) AS BIGINT) AS total FROM runs_full)
UNION ALL SELECT 'delivery_retries', CAST(sum(attempts-1) AS BIGINT) FROM outbox""", "runs_full", "outbox"))
def pipeline_totals(spark, sf_dir):
    return reports.pipeline_totals(store(spark, sf_dir, "runs"), fixtures.table(spark, sf_dir, "outbox"))


@register("scan_mode_compare", query("""
SELECT run_id, count(*) AS all_dates, count(*) FILTER (WHERE CAST(created_at AS DATE)=run_date) AS in_window,
  count(*) FILTER (WHERE CAST(created_at AS DATE)<>run_date) AS outside_window FROM verdicts GROUP BY run_id""", "verdicts"))
def scan_mode_compare(spark, sf_dir):
    inside = F.col("created_at").cast("date") == F.col("run_date")
    return store(spark, sf_dir, "verdicts").groupBy("run_id").agg(
        F.count("*").alias("all_dates"), F.count_if(inside).alias("in_window"), F.count_if(~inside).alias("outside_window"))


# ---- coverage

def _pairs(spark, sf_dir) -> DataFrame:
    """Ids on the landed pages of each day, and ids whose current verdict a run of the local day has written."""
    return coverage.compare_ids(store(spark, sf_dir, "page_ids"), store(spark, sf_dir, "current_days"))


_PAIRS = """(SELECT day, gtin, max(f) AS f, max(s) AS s FROM (
  SELECT run_date AS day, trim(gtin) AS gtin, 1 AS f, 0 AS s FROM products WHERE trim(gtin)<>'' UNION ALL
  SELECT ist_day, vgtin, 0, 1 FROM current JOIN run_days USING (run_id) WHERE trim(vgtin)<>'') GROUP BY 1, 2)"""


@register("coverage_summary", query(f"""
SELECT *, CASE WHEN feed_ids>0 THEN round(stored_ids*100.0/feed_ids,2) ELSE 0.0 END AS coverage_pct,
  CASE WHEN feed_ids=0 AND ingested>0 THEN 'no feed data, stored '||round(stored_ids*100.0/ingested,1)||'% of ingested'
    WHEN feed_ids=0 THEN 'no feed data' WHEN missing>0 THEN 'missing '||missing ELSE '100% coverage' END AS verdict
FROM (SELECT coalesce(c.day, i.day) AS day, coalesce(feed_ids,0) AS feed_ids, coalesce(stored_ids,0) AS stored_ids,
  coalesce(missing,0) AS missing, coalesce(extra,0) AS extra, coalesce(ingested,0) AS ingested FROM (SELECT day, count(*) FILTER (WHERE f=1)
  AS feed_ids, count(*) FILTER (WHERE s=1) AS stored_ids, count(*) FILTER (WHERE s=0) AS missing, count(*) FILTER (WHERE f=0) AS extra
  FROM {_PAIRS} GROUP BY 1) c FULL OUTER JOIN (SELECT ist_day AS day, CAST(sum(items_fetched) AS BIGINT) AS ingested FROM run_days
  GROUP BY 1) i ON c.day=i.day)""", "products", "current", "run_days"))
def coverage_summary(spark, sf_dir):
    runs_of_day = store(spark, sf_dir, "run_list").withColumn("day", dates.local_day(F.col("start_time")))
    return coverage.summary(_pairs(spark, sf_dir), runs_of_day)


@register("coverage_missing", query(f"SELECT day, gtin FROM {_PAIRS} WHERE s=0", "products", "current", "run_days"))
def coverage_missing(spark, sf_dir):
    return coverage.missing(_pairs(spark, sf_dir))


@register("coverage_missing_sample", query(f"""SELECT day, gtin FROM {_PAIRS} WHERE s=0
QUALIFY row_number() OVER (PARTITION BY day ORDER BY gtin)<=10""", "products", "current", "run_days"))
def coverage_missing_sample(spark, sf_dir):
    return coverage.missing_sample(_pairs(spark, sf_dir))


@register("coverage_extra", query(f"SELECT day, gtin FROM {_PAIRS} WHERE f=0", "products", "current", "run_days"))
def coverage_extra(spark, sf_dir):
    return coverage.extra(_pairs(spark, sf_dir))


def _id_list(spark, sf_dir):
    """An id list file as people keep them: ids with spaces and repeats, days as
    text or as spreadsheet numbers, some blank ids."""
    path = scratch_path(spark, "ids")
    k = F.col("p_partkey")
    part = fixtures.table(spark, sf_dir, "part")
    rows = part.select(k, k.alias("n")).unionByName(part.select(k, F.floor(k / 2).alias("n")))
    day = F.when(k % 2 == 0, F.lit("46085")).otherwise(F.lit("2026-03-05T10:00:00"))
    rows.select(F.when(F.col("n") % 71 == 0, F.lit("")).otherwise(
        F.concat(F.lit(" 890"), F.lpad(F.col("n").cast("string"), 10, "0"))).alias("Gtin"), day.alias("Created at"),
        k.cast("string").alias("Approval Status")).write.option("header", True).csv(path)
    return id_list.load(id_list.read(spark, path), first_by=["Created at", "Approval Status"])


_IDS = """(SELECT gtin, CASE WHEN c='46085' THEN '2026-03-04' ELSE '2026-03-05' END AS created_at, a AS approval_status
FROM (SELECT gtin, c, a, row_number() OVER (PARTITION BY gtin ORDER BY c, a) AS rn FROM (
  SELECT '890'||lpad(CAST(n AS VARCHAR),10,'0') AS gtin, CASE WHEN k%2=0 THEN '46085' ELSE '2026-03-05T10:00:00' END AS c,
    CAST(k AS VARCHAR) AS a FROM (SELECT p_partkey AS k, p_partkey AS n FROM part UNION ALL
    SELECT p_partkey, p_partkey//2 FROM part) WHERE n%71<>0)) WHERE rn=1)"""
_COVERED = f"""(SELECT l.gtin, v.validation_status, r.delivered_count>0 AS run_delivered FROM {_IDS} l
LEFT JOIN (SELECT * EXCLUDE (rn), row_number() OVER (PARTITION BY trim(vgtin) ORDER BY created_at DESC, batch_id DESC,
  item_pos DESC) AS rn FROM current WHERE trim(vgtin)<>'') v ON trim(v.vgtin)=l.gtin AND v.rn=1 LEFT JOIN runs r ON r.run_id=v.run_id)"""


@register("id_list_load", f"SELECT gtin, created_at, approval_status FROM {_IDS}")
def id_list_load(spark, sf_dir):
    return _id_list(spark, sf_dir).select("gtin", "created_at", "approval_status")


def _covered(spark, sf_dir):
    return coverage.list_coverage(_id_list(spark, sf_dir), current(spark, sf_dir), store(spark, sf_dir, "run_list"))


@register("id_list_coverage", query(f"""
SELECT gtin, validation_status, run_delivered, validation_status IS NOT NULL AS present FROM {_COVERED}""",
                                    "current", "runs"))
def id_list_coverage(spark, sf_dir):
    return _covered(spark, sf_dir).select("gtin", "validation_status", "run_delivered", "present")


_ON_LAST_DAY = _COVERED.replace("FROM current WHERE", """FROM current WHERE run_id IN (SELECT run_id FROM runs
  WHERE (SELECT max(from_date) FROM runs) BETWEEN from_date AND to_date) AND""")


@register("id_list_coverage_last_day", query(f"""
SELECT gtin, validation_status, run_delivered, validation_status IS NOT NULL AS present FROM {_ON_LAST_DAY}""", "current", "runs"))
def id_list_coverage_last_day(spark, sf_dir):
    """Only verdicts of runs whose window holds the last day of the feed count."""
    r = store(spark, sf_dir, "run_list")
    covered = coverage.list_coverage(_id_list(spark, sf_dir), current(spark, sf_dir), r, r.agg(F.max("from_date").alias("d")).scalar())
    return covered.select("gtin", "validation_status", "run_delivered", "present")


@register("id_list_status_counts", query(f"""
SELECT coalesce(validation_status,'missing') AS status, count(*) AS n,
  count(*) FILTER (WHERE run_delivered) AS in_delivered_runs FROM {_COVERED} GROUP BY 1""", "current", "runs"))
def id_list_status_counts(spark, sf_dir):
    return coverage.list_status_counts(_covered(spark, sf_dir))


# ---- delivery

DUE_AT = "1999-01-01 00:00:00"


@register("retriable_outcomes", query("""
SELECT outbox_id, http_status IS NULL OR http_status=429 OR http_status BETWEEN 500 AND 599 AS retriable FROM outbox""",
                                      "outbox"))
def retriable_outcomes(spark, sf_dir):
    return fixtures.table(spark, sf_dir, "outbox").select(
        "outbox_id", delivery.retriable(F.col("http_status")).alias("retriable"))


@register("outbox_enqueue", query("""
SELECT outbox_id, run_id, batch_id, payload, CAST(1 AS INT) AS attempts, 'PENDING' AS status,
  CAST(next_retry_at + INTERVAL 2 MINUTE AS VARCHAR) AS next_retry_at,
  coalesce('status '||http_status, 'no response') AS last_error FROM outbox
WHERE http_status IS NULL OR http_status NOT BETWEEN 200 AND 299""", "outbox"))
def outbox_enqueue(spark, sf_dir):
    path = scratch_path(spark, "outbox")
    delivery.append_outbox(fixtures.table(spark, sf_dir, "outbox"), "next_retry_at", path)
    return spark.read.parquet(path).withColumn("next_retry_at", F.col("next_retry_at").cast("string"))


@register("outbox_due", query(f"""
SELECT outbox_id, batch_id, attempts FROM outbox WHERE status='PENDING' AND next_retry_at <= TIMESTAMP '{DUE_AT}'
ORDER BY next_retry_at, outbox_id LIMIT 50""", "outbox"))
def outbox_due(spark, sf_dir):
    return delivery.due(fixtures.table(spark, sf_dir, "outbox"), ntz(DUE_AT)).select("outbox_id", "batch_id", "attempts")


@register("outbox_transition", query(f"""
SELECT outbox_id, CASE WHEN due AND http_status BETWEEN 200 AND 299 THEN 'DELIVERED' ELSE status END AS status,
  CASE WHEN due AND NOT coalesce(http_status BETWEEN 200 AND 299,false) THEN attempts+1 ELSE attempts END AS attempts,
  CAST(CASE WHEN due AND NOT coalesce(http_status BETWEEN 200 AND 299,false) THEN TIMESTAMP '{DUE_AT}'
    + INTERVAL 1 SECOND * least(CAST(pow(2,attempts+1) AS INT),600) ELSE next_retry_at END AS VARCHAR) AS next_retry_at,
  CASE WHEN due AND NOT coalesce(http_status BETWEEN 200 AND 299,false) THEN coalesce('status '||http_status, 'no response')
    ELSE last_error END AS last_error
FROM (SELECT *, status='PENDING' AND next_retry_at <= TIMESTAMP '{DUE_AT}' AS due FROM outbox)""", "outbox"))
def outbox_transition(spark, sf_dir):
    return delivery.transition(fixtures.table(spark, sf_dir, "outbox"), ntz(DUE_AT)).select(
        "outbox_id", "status", "attempts", text("next_retry_at"), "last_error")


def _keys(spark, sf_dir):
    key = delivery.idempotency_key(F.col("gtin"), F.col("validation_status"))
    return store(spark, sf_dir, "verdicts").select("rid", "run_id", "batch_id", "item_pos", "created_at",
                                                   key.alias("idempotency_key"))


@register("idempotency_keys", query("""
SELECT rid, sha256(vgtin||'|'||validation_status) AS idempotency_key FROM verdicts""", "verdicts"))
def idempotency_keys(spark, sf_dir):
    return _keys(spark, sf_dir).select("rid", "idempotency_key")


_RUN_KEYS = """(SELECT v.*, sha256(vgtin||'|'||validation_status) AS idempotency_key FROM verdicts v JOIN runs USING (run_id)
  WHERE status{} 'SUCCESS')"""


@register("idempotency_insert", query(f"""
SELECT idempotency_key, run_id, batch_id FROM (SELECT *, row_number() OVER (PARTITION BY idempotency_key
  ORDER BY created_at, batch_id, item_pos) AS rn FROM {_RUN_KEYS.format('<>')}) WHERE rn=1
  AND idempotency_key NOT IN (SELECT idempotency_key FROM {_RUN_KEYS.format('=')})""", "verdicts", "runs"))
def idempotency_insert(spark, sf_dir):
    """Keys that the runs still to be delivered add to those of the runs that succeeded."""
    keys = _keys(spark, sf_dir).join(store(spark, sf_dir, "run_list").select("run_id", "status"), "run_id")
    known, arrived = keys.where("status = 'SUCCESS'"), keys.where("status <> 'SUCCESS'")
    return delivery.insert_keys(known, arrived).select("idempotency_key", "run_id", "batch_id")


# ---- monitoring

def _polls(spark, sf_dir):
    """The poll series with the poll before each, computed once for all that read it."""
    return store(spark, sf_dir, "polls")


@register("source_growth", query("""
SELECT run_no, event_id, source_total-p_total AS growth, CAST(floor(epoch(date_trunc('second',ts)
  -date_trunc('second',p_ts))/60) AS BIGINT) AS minutes FROM polls WHERE p_ts IS NOT NULL""", "polls"))
def source_growth(spark, sf_dir):
    p = _polls(spark, sf_dir)
    whole = {c: F.date_trunc("second", c).cast("timestamp_ntz") for c in ("ts", "prev_ts")}
    return monitor.growth(p.withColumns(whole))


@register("monitor_arrivals", query("""
SELECT run_no, event_id, CAST(ts AS VARCHAR) AS ts, source_total, source_total-p_total AS new_items,
  p_total AS previous_total FROM polls WHERE source_total>p_total""", "polls"))
def monitor_arrivals(spark, sf_dir):
    out = monitor.arrivals(_polls(spark, sf_dir))
    return out.withColumn("ts", F.col("ts").cast("string"))


@register("monitor_fetches", query("""
SELECT run_no, event_id, items_fetched-coalesce(p_items,0) AS items, items_fetched AS total_fetched,
  greatest(0, source_total-items_fetched) AS remaining FROM polls WHERE items_fetched>coalesce(p_items,0)""",
                                   "polls").replace(fixtures.FETCH_STEPS, fixtures.ALL_STEPS))
def monitor_fetches(spark, sf_dir):
    """Every click and purchase of a run is a fetch."""
    return monitor.fetches(store(spark, sf_dir, "fetch_polls")).drop("ts")


STALLS = query("""
SELECT run_no, count(*) AS polls, min(event_id) AS first_event FROM (SELECT *, CAST(sum(CASE WHEN moved THEN 1 ELSE 0 END)
  OVER (PARTITION BY run_no ORDER BY ts, event_id) AS BIGINT) AS island FROM (SELECT *, items_fetched<>coalesce(p_items,0)
  OR status<>'RUNNING' AS moved FROM polls)) WHERE NOT moved GROUP BY run_no, island HAVING count(*)>10""", "polls")


@register("run_stalls", STALLS)
def run_stalls(spark, sf_dir):
    series = _polls(spark, sf_dir)
    return monitor.stalls(series, monitor.STALL_POLLS, F.min("event_id").alias("first_event")).select("run_no", "polls", "first_event")


@register("monitor_intervals", query("""
SELECT run_no, CAST(time_bucket(INTERVAL 5 MINUTE, ts) AS VARCHAR) AS interval_start,
  count(*) FILTER (WHERE source_total>p_total) AS new_arrivals,
  count(*) FILTER (WHERE items_fetched>coalesce(p_items,0)) AS fetch_events FROM polls GROUP BY 1,2""", "polls"))
def monitor_intervals(spark, sf_dir):
    out = monitor.intervals(_polls(spark, sf_dir))
    return out.withColumn("interval_start", F.col("interval_start").cast("string"))


_MONITOR_SUMMARY = """
SELECT *, CASE WHEN final_total>initial_total THEN 'up' WHEN final_total<initial_total THEN 'down' ELSE 'none' END
  AS direction FROM (SELECT run_no, count(*) AS total_reports, arg_min(items_fetched, (ts,event_id)) AS initial_items,
  arg_max(items_fetched, (ts,event_id)) AS final_items, arg_min(source_total, (ts,event_id)) AS initial_total,
  arg_max(source_total, (ts,event_id)) AS final_total, count(*) FILTER (WHERE source_total>p_total) AS arrival_events,
  count(*) FILTER (WHERE items_fetched>coalesce(p_items,0)) AS fetch_events,
  CAST(coalesce(sum(source_total-p_total) FILTER (WHERE source_total>p_total),0) AS BIGINT) AS arrived,
  CAST(sum(items_fetched-coalesce(p_items,0)) AS BIGINT) AS fetched FROM polls GROUP BY run_no)"""


@register("monitor_summary", query(_MONITOR_SUMMARY, "polls"))
def monitor_summary(spark, sf_dir):
    return monitor.summary(_polls(spark, sf_dir))


@register("monitor_summary_file", query(_MONITOR_SUMMARY, "polls"))
def monitor_summary_file(spark, sf_dir):
    """The summary of each run as a JSON file, read back."""
    path = scratch_path(spark, "monitor-summary")
    rows = monitor_summary(spark, sf_dir)
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    outputs.write_json(rows.withColumn("run", F.col("run_no")), path, ["run"], rows.columns, tasks=tasks)
    # The rows name their run, so the folders are not parsed for it.
    return spark.read.schema(rows.schema).option("recursiveFileLookup", "true").json(path)


_ARRIVAL_FILE = ["ts", "event_id", "source_total", "new_items", "previous_total"]


@register("monitor_arrivals_file", query(f"""
SELECT CAST(run_no AS VARCHAR) AS run, row_number() OVER (PARTITION BY run_no ORDER BY ts, event_id) AS line_no,
  {_csv_sql(*_ARRIVAL_FILE)} AS line FROM (SELECT run_no, event_id, CAST(ts AS VARCHAR) AS ts, source_total,
  source_total-p_total AS new_items, p_total AS previous_total FROM polls WHERE source_total>p_total)
UNION ALL SELECT DISTINCT CAST(run_no AS VARCHAR), 0, '{",".join(_ARRIVAL_FILE)}' FROM polls WHERE source_total>p_total""", "polls"))
def monitor_arrivals_file(spark, sf_dir):
    """New items of each run as a CSV file in the order of the polls, read back as it stands."""
    path = scratch_path(spark, "monitor-arrivals")
    rows = monitor_arrivals(spark, sf_dir).withColumn("run", F.col("run_no"))
    outputs.write_csv(rows, path, ["run"], ["ts", "event_id"], _ARRIVAL_FILE)
    return outputs.read_lines(spark, path, ["run"]).withColumn("line_no", F.col("line_no").cast("long"))



@register("run_gaps", query("""
SELECT run_id, gap_minutes FROM (SELECT run_id, CAST(floor(date_diff('second', lag(end_time) OVER (PARTITION BY from_date
  ORDER BY start_time, run_id), start_time)/60) AS BIGINT) AS gap_minutes FROM runs) WHERE gap_minutes>30""", "runs"))
def run_gaps(spark, sf_dir):
    return monitor.run_gaps(store(spark, sf_dir, "run_list")).select("run_id", "gap_minutes")
