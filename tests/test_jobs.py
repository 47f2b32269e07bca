"""Operators on small frames, and registered queries against their SQL."""

import os

import pytest
from pyspark.sql import functions as F

from tallyline.operators import coverage, monitor, normalize, publish, reports, validate, verdict_store
from tallyline.operators.ordering import with_position
from tallyline.plans import catalog, check
from tallyline.sinks import day_log, files, outputs
from tallyline.session import scratch_path
from tallyline.sources import feed, id_list, synthetic
from tallyline.streaming import jobs

SF = "/root/testdata/sf0.001"


def test_load_test_products_are_all_rejected_alike(spark):
    made = validate.validate_json(synthetic.load_test(spark, 900), ["i", "batch_no"])
    rows = made.select(F.slice("reasons", 1, 9).alias("r"), "validation_status", "batch_no").collect()
    assert len(rows) == 900 and {r["validation_status"] for r in rows} == {"Rejected"}
    assert {tuple(x.split(":")[0] for x in r["r"]) for r in rows} == {
        ("Gross Weight", "Gross Weight Unit", "Net Weight", "Net Weight Unit")}
    assert {r["batch_no"] for r in rows} == set(range(9))


def test_two_level_windows_match_plain_ones(spark):
    # One key holds most rows.
    rows = spark.range(3000).select(
        F.when(F.col("id") % 10 < 9, 0).otherwise(F.col("id") % 7).alias("k"), F.col("id").alias("e"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), (F.hash("id") % 20000)
                                                                        .cast("int"))).alias("t"),
        (F.hash("id") % 5).cast("long").alias("v"))
    got = monitor.previous(monitor.running_sum(rows, ["k"], ["t", "e"], F.col("v"), "s"), ["k"], ["t", "e"], ["v", "t"])
    a = sorted(tuple(r) for r in got.select("k", "e", "s", "prev_v", "prev_t").collect())
    rows.createOrReplaceTempView("plain")
    b = sorted(tuple(r) for r in spark.sql("""SELECT k, e, sum(v) OVER w AS s, lag(v) OVER w, lag(t) OVER w FROM plain
        WINDOW w AS (PARTITION BY k ORDER BY t, e)""").collect())
    assert [x[:3] for x in a] == [x[:3] for x in b] and [str(x) for x in a] == [str(x) for x in b]


def test_positions_and_chunks(spark):
    rows = spark.range(0, 2500, numPartitions=5).select((F.hash("id") % 3).alias("a"), F.col("id").alias("b"))
    placed = sorted((r["a"], r["b"], r["position"]) for r in with_position(rows, ["a", "b"]).collect())
    assert [p for _, _, p in placed] == list(range(2500))
    days = spark.range(25).select((F.col("id") % 2).cast("string").alias("day"), F.col("id").cast("string").alias("gtin"),
                                  *[F.col("id").alias(f"first_{c}") for c in ("created_at", "batch_id", "item_pos")])
    sizes = {(r["day"], r["chunk_id"]): r["count"]
             for r in publish.chunked(days, 5).groupBy("day", "chunk_id").count().collect()}
    assert sizes == {("0", 0): 5, ("0", 1): 5, ("0", 2): 3, ("1", 0): 5, ("1", 1): 5, ("1", 2): 2}


def test_envelope(spark):
    pages = ['{"items":{},"data":[{"gtin":1}],"pageInfo":{"nextCursor":"c"}}',
             '{"products":[1,2],"nextCursor":null,"pageInfo":{"nextCursor":"d","hasNextPage":false}}',
             '{"items":[],"data":[1],"hasNextPage":"yes"}']
    frame = spark.createDataFrame([(p,) for p in pages], "s string").withColumn("v", F.parse_json("s"))
    got = [(r["n"], r["next_cursor"], r["has_next_page"]) for r in feed.decode_envelope(frame, F.col("v"))
           .select(F.size("items").alias("n"), "next_cursor", "has_next_page").collect()]
    assert got == [(1, "c", True), (2, "d", False), (0, None, False)]


def test_daily_csv_quotes_everything(spark, tmp_path):
    rows = spark.createDataFrame([("", "Rejected", ['a "b"', "c"], "2026-01-02")],
                                 "gtin string, validation_status string, reasons array<string>, day string")
    for _ in range(2):  # the header comes once, also when the day goes on
        files.append_daily_csv(rows, str(tmp_path / "out"), "day")
    folder = tmp_path / "out" / "day=2026-01-02"
    text = sorted((open(folder / f).read() for f in os.listdir(folder) if f.startswith("part-")), reverse=True)
    row = '"","Rejected","a ""b""; c","2026-01-02"'
    assert [t.splitlines() for t in text] == [["GTIN_number,Status,Reason,Date", row], [row]]


def test_a_group_of_files_is_replaced_whole_and_in_order(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = lambda day, n: spark.range(n).select(F.lit(day).alias("day"), "id", F.concat(F.lit('a,"'), "id").alias("t"), F.lit(None).alias("e")).repartition(5)
    outputs.write_csv(rows("2026-01-01", 300).unionByName(rows("2026-01-02", 3)), path, ["day"], ["id"], ["id", "t", "e"])
    outputs.write_csv(rows("2026-01-02", 2), path, ["day"], ["id"], ["id", "t", "e"], always=True)
    got = [(r["day"], r["line"]) for r in outputs.read_lines(spark, path, ["day"]).orderBy("day", "line_no").collect()]
    assert got == [("2026-01-01", "id,t,e"), *[("2026-01-01", f'{i},"a,""{i}",') for i in range(300)],
                   ("2026-01-02", '"id","t","e"'), *[("2026-01-02", f'"{i}","a,""{i}",""') for i in range(2)]]
    assert (tmp_path / "out" / "_SUCCESS").exists()
    broken = rows("2026-01-01", 9).withColumn("t", F.when(F.col("id") == 7, F.raise_error("lost")).otherwise("x"))
    with pytest.raises(Exception, match="lost"):
        outputs.write_csv(broken, path, ["day"], ["id"], ["id", "t", "e"])
    assert outputs.read_lines(spark, path, ["day"]).where("day = '2026-01-01'").count() == 301 and not (tmp_path / "out" / "_SUCCESS").exists()


def test_a_day_with_fewer_chunks_replaces_all_of_them(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = lambda day, n: spark.range(n).select(F.lit(day).alias("day"), F.col("id").alias("chunk_id"), F.concat(F.lit(f"{n}:"), "id").alias("payload"))
    outputs.write_chunks(rows("2026-01-01", 3).unionByName(rows("2026-01-02", 12)), path, "day", "chunk_id")
    outputs.write_chunks(rows("2026-01-02", 2), path, "day", "chunk_id")
    got = sorted(map(tuple, spark.read.schema("payload string, day string, chunk_id long").text(path).select("day", "chunk_id", "payload").collect()))
    assert got == [*[("2026-01-01", k, f"3:{k}") for k in range(3)], *[("2026-01-02", k, f"2:{k}") for k in range(2)]]
    assert (tmp_path / "out" / "_SUCCESS").exists()


def test_id_list_headers_and_duplicates(spark):
    rows = spark.createDataFrame([(" 1 ", "46085"), ("1", "2026-03-09T1"), ("", "46085"), ("2", "")],
                                 ["GTIN Number", "Created at"])
    got = sorted((r["gtin"], r["created_at"]) for r in id_list.load(rows).collect())
    assert got == [("1", "2026-03-04"), ("2", "")]


def _land(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(spark.createDataFrame([], schema).schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_held_and_late_deliveries_are_released_by_later_runs(spark):
    path, root, check_at = (scratch_path(spark, n) for n in ("in", "release", "checkpoint"))
    schema, hours = "gtin string, created_at timestamp_ntz", []
    at = lambda day, hour=0: __import__("datetime").datetime(2026, 1, day, hour)

    def run(now, rows):
        out = jobs.release_run(_land(spark, rows, schema, path), 6, now, root, check_at)
        hours.append(sorted(files.folders(spark, f"{root}/waiting", "due_hour=")))
        return sorted(r["gtin"] for r in spark.read.parquet(out).collect()) if rows is not None else None

    assert run("2026-01-01 06:00:00", [("a", at(1)), ("b", at(1, 1)), ("c", at(20))]) == ["a"]
    # New files, one row of them late; then nothing new at all, only a later time.
    assert run("2026-01-02 00:00:00", [("d", at(1)), ("e", at(3))]) == ["a", "b", "d"]
    assert run("2026-01-10 00:00:00", []) == ["a", "b", "d", "e"]
    assert run("2026-02-10 00:00:00", []) == ["a", "b", "c", "d", "e"]
    assert run("2026-02-10 00:00:00", []) == ["a", "b", "c", "d", "e"]
    # Delivered hours are gone; the running hour stays until it is over.
    assert hours == [["2026010106", "2026010107", "2026012006"], ["2026010306", "2026012006"], ["2026012006"], [], []]


def test_a_release_that_is_lost_delivers_once(spark, monkeypatch):
    import datetime as dt

    path, root, check_at = (scratch_path(spark, n) for n in ("in", "release", "checkpoint"))
    stream = _land(spark, [("a", dt.datetime(2026, 1, 1)), ("b", dt.datetime(2026, 1, 1, 2))], "gtin string, created_at timestamp_ntz", path)
    read = lambda: sorted(r["gtin"] for r in spark.read.parquet(f"{root}/delivered").collect())

    def fails(*_):
        raise RuntimeError("lost")

    for name in ("replace_text", "delete"):  # before its state is written, and before its folders go
        with monkeypatch.context() as m, pytest.raises(RuntimeError, match="lost"):
            m.setattr(files, name, fails)
            jobs.release_run(stream, 1, "2026-01-01 02:30:00", root, check_at)
        assert read() == ["a"]
    for _ in range(2):
        jobs.release_run(stream, 1, "2026-01-01 02:40:00", root, check_at)
        assert read() == ["a"]
    jobs.release_run(stream, 1, "2026-01-01 03:00:00", root, check_at)
    assert read() == ["a", "b"]


def test_late_keys_and_polls_count_and_restarts_repeat_nothing(spark):
    import datetime as dt

    day = lambda n: dt.datetime(2026, 1, n, tzinfo=dt.UTC)
    path, out, at = (scratch_path(spark, n) for n in ("keys", "delivered", "checkpoint"))
    for rows in ([("k1", day(25)), ("k2", day(25)), ("k1", day(26))], [("k1", day(1)), ("k3", day(3))], []):
        stream = _land(spark, rows, "idempotency_key string, delivered_at timestamp", path)
        jobs.first_deliveries(stream, out, at).awaitTermination()
    got = sorted((r["idempotency_key"], r["delivered_at"].day) for r in jobs.key_table(spark, out).read().collect())
    assert got == [("k1", 25), ("k2", 25), ("k3", 3)]

    path, out, at = (scratch_path(spark, n) for n in ("polls", "windows", "checkpoint"))
    for rows in ([("r", day(5), 3)], [("r", day(5), 9), ("r", day(1), 4)], [("s", day(9), 1)]):
        jobs.poll_windows(_land(spark, rows, "run_no string, ts timestamp, source_total long", path), out, at).awaitTermination()
    got = sorted((r["run_no"], r["interval_start"].day, r["polls"], r["max_total"]) for r in jobs.merged_windows(spark, out).collect())
    assert got == [("r", 1, 1, 4), ("r", 5, 2, 9), ("s", 9, 1, 1)]


def test_pages_become_verdicts_and_quarantine_in_one_pass(spark, tmp_path):
    landing = tmp_path / "pages"
    landing.mkdir()
    pages = ['{"runId":"r","batchId":1,"payload":{"items":[{"gtin":"1"},{"gtin": 2.50, "name":"a\\"b]"}]}}', '{"runId": broken',
             '{"runId":7,"batchId":"12","fromDate":null,"payload":{"items":{},"data":[],"products":[{"gtin":"3"}]}}', "", "  ",
             '{"payload":{"items":[],"data":[{"gtin":"4"}]}}', '{"runId":"x"}', "[1]", "5", "{'runId':'q'}",
             '{"runId":"y","payload":{"data":[5,null,{"gtin":"6"}],"pageInfo":{"a":[1]}},"extra":[{}]}', '{"payload":{"items":[{"gtin":"7"}]}} x']
    (landing / "a").write_text("\n".join(pages) + "\n")
    for n in range(2):  # the second pass restarts on the same checkpoint
        jobs.write_pages(feed.stream_lines(spark, str(landing)), str(tmp_path / "v"), str(tmp_path / "c")).awaitTermination()
    got = jobs.read_verdicts(spark, str(tmp_path / "v"))
    by_variant = validate.validate_variant(feed.page_items(feed.read_pages(spark, str(landing))), jobs.ITEM_KEEP)
    rows = lambda df: sorted((tuple(r) for r in df.select(*by_variant.columns).collect()), key=repr)
    assert rows(got) == rows(by_variant) and got.count() == 6
    assert {r["gtin"] for r in got.collect()} >= {"1", "6", "7"}
    bad = jobs.read_quarantine(spark, str(tmp_path / "v")).collect()
    assert sorted(tuple(r) for r in bad) == [('{"runId": broken', "unparseable page"), ("{'runId':'q'}", "unparseable page")]


def test_one_odd_price_does_not_end_the_job(spark):
    raw = '{"gtin":"1","mrp":[{"mrp":"0x%s","target_market":"India"}]}' % ("f" * 20)
    made = validate.validate_json(spark.createDataFrame([(raw,)], "raw string"), []).collect()
    assert not any(r.startswith("MRP: ") for r in made[0]["reasons"])


def test_publishing_sends_the_current_verdict(spark):
    rows = [("1", "r1", 1, 1, "2026-01-01 08:00:00", "Rejected", '{"a":1,"b":2,"c":3}'),
            ("1", "r1", 2, 1, "2026-01-01 15:00:00", "Accepted", '{"a":1,"b":2}')]
    log = spark.createDataFrame(rows, "gtin string, run_id string, batch_id int, item_pos int, created_at string, validation_status string, raw string")
    log = log.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))
    runs = spark.createDataFrame([("r1", "2026-01-01 07:00:00", "2026-01-01", "2026-01-02", 5)], "run_id string, start_time string, from_date string, to_date string, delivered_count int")
    runs = runs.withColumns({"start_time": F.col("start_time").cast("timestamp_ntz"), "from_date": F.col("from_date").cast("date"), "to_date": F.col("to_date").cast("date")})
    current = verdict_store.latest(log)
    best = publish.richest(verdict_store.with_run_day(current, runs)).collect()
    assert [(r["batch_id"], r["n_keys"]) for r in best] == [(2, 2)]
    ids = spark.createDataFrame([("1",), ("2",)], "gtin string")
    for day, want in ((None, "Accepted"), ("2026-01-02", "Accepted"), ("2026-01-03", None)):
        got = {r["gtin"]: r["validation_status"] for r in coverage.list_coverage(ids, current, runs, day).collect()}
        assert got == {"1": want, "2": None}
    day = spark.createDataFrame([("2026-01-02",), ("2026-01-02",), ("2026-01-09",)], "day string").select(F.col("day").cast("date").alias("day"))
    assert verdict_store.in_run_window(current, runs, day).count() == 1
    assert verdict_store.in_run_window(current, runs).count() == 2


def test_days_meet_windows_in_bins(spark):
    import datetime as dt

    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n)
    spans = [(f"r{i}", day(i * 7), day(i * 7 + (i * 37) % 200 - 3)) for i in range(60)] + [("long", day(-5000), day(5000)), ("none", None, day(3))]
    runs = spark.createDataFrame(spans, "run_id string, from_date date, to_date date")
    days = spark.createDataFrame([(day(n),) for n in range(-40, 500, 13)] + [(None,)], "day date")
    got = sorted(tuple(r) for r in verdict_store.runs_on_days(runs, days).collect())
    assert got == sorted((r, day(n)) for r, a, z in spans for n in range(-40, 500, 13) if a and a <= day(n) <= z)
    verdicts = spark.createDataFrame([(r, g) for r, *_ in spans for g in ("1", "")], "run_id string, gtin string")
    spread = verdict_store.in_run_window(verdicts, runs)
    assert spread.count() == sum((z - a).days + 1 for _, a, z in spans if a and a <= z)
    plan = spread._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate explode") < plan.index("Join")  # the days come after the shuffle
    assert sorted(tuple(r) for r in verdict_store.in_run_window(verdicts, runs, days).select("run_id", "day").collect()) == got


def test_a_day_is_read_and_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = lambda *x: spark.createDataFrame(x, "day string, n int").withColumn("day", F.col("day").cast("date"))
    day_log.write_days(rows(("2026-01-01", 1), ("2026-01-02", 2), ("2026-01-02", 3), ("2026-01-03", 4)), path)
    day_log.write_days(rows(("2026-01-02", 5)), path)
    one = day_log.read_days(spark, path, "2026-01-02", "2026-01-02")
    assert "PartitionFilters: [isnotnull(day" in one._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["n"] for r in day_log.read_days(spark, path).collect()) == [1, 4, 5]
    assert sorted(r["n"] for r in day_log.read_days(spark, path, last="2026-01-02").collect()) == [1, 5]
    assert [r["n"] for r in one.collect()] == [5] and one.select("_metadata.file_path").distinct().count() == 1


@pytest.mark.parametrize("key", ["backfill_window_scan", "verdicts_for_last_day"])
def test_jobs_for_some_days_prune_partitions(spark, key):
    df = catalog.QUERIES[key](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(" in plan


def test_continuity_has_all_its_outcomes(spark):
    rows = [("a", 2, "2026-01-01 01:00:00", True), ("b", 2, "2026-01-01 01:00:00", False), ("c", 1, "2026-01-01 09:00:00", True),
            ("d", 1, "2026-01-01 08:00:00", True), ("e", 1, "2026-01-01 09:59:00", None), ("f", 2, "2026-01-01 09:59:00", None)]
    days = spark.createDataFrame(rows, "day string, total_runs int, newest string, grew boolean").select(
        "day", "total_runs", F.col("newest").cast("timestamp_ntz").alias("newest"), "grew", F.lit("2026-01-01 09:59:59").cast("timestamp_ntz").alias("now"))
    got = {r["day"]: r["verdict"] for r in reports.continuity(days).collect()}
    assert got == {"a": "working", "b": "insufficient data", "c": "working", "d": "single run", "e": "insufficient data", "f": "insufficient data"}


def test_layout_fills_every_column_through_every_alias(spark):
    import json

    def record(alias, value):
        """The smallest record that has ``value`` at the alias."""
        if alias.startswith("['"):
            return {alias[2:-2]: value}
        steps = alias[1:].replace("[0]", ".0").split(".")
        for step in reversed(steps):
            value = [value] if step == "0" else {step: value}
        return value

    cases = [(c, a) for c, listed in publish.LAYOUT.items() for a in listed if not a.startswith("$")]
    values = [(f"  text {n} ", f"text {n}") if n % 3 else (n + 0.50, f"{n}.5") for n in range(len(cases))]
    rows = [(n, json.dumps(record(a, v[0])), "g", "Accepted", ["r", "s"]) for n, ((_, a), v) in enumerate(zip(cases, values, strict=True))]
    rows.append((len(cases), "no json", "g", None, []))
    frame = spark.createDataFrame(rows, "n int, raw string, gtin string, validation_status string, reasons array<string>")
    got = {r["n"]: r for r in publish.layout(frame, ["n"]).collect()}
    for n, ((column, alias), (_, want)) in enumerate(zip(cases, values, strict=True)):
        filled = {c: got[n][c] for c in publish.LAYOUT if got[n][c]}
        assert filled == {column: want, "GTIN": "g", "AI Verified Status": "Accepted", "AI Verified Reason": "r; s"}, alias
    assert [c for c in publish.LAYOUT if got[len(cases)][c]] == ["GTIN"]


def test_layout_parses_a_record_once_and_reads_odd_shapes_alike(spark):
    """every path was looked up on its own. Texts, types, and details that are no object or list print as before."""
    raws = {
        '{"name":"1.50","brand":1.50,"Price":-0,"price":"-0","Email":[1,null,"a"],"images":{"front":{"a":1}}}':
            {"Product Name": "1.50", "Brand Name": "1.5", "Price": "0", "Email": "1,,a", "Front Image": "[object Object]"},
        '{"mrp":[{"mrp":5.0,"location":" x "},7],"name":"[n]"}': {"Price": "5", "Location MRP": "x", "Product Name": "[n]"},
        '{"mrp":[7,{"mrp":5}],"company_detail":"{\\"name\\":\\"y\\"}","hs_code":"h"}': {"HS Code": "h"},
        '{"mrp":{"mrp":5},"images":null,"name":"a","name":"b"}': {"Product Name": "b"},
        "{'name':'x'}": {}, '{"name":NaN}': {}, '{"name":"a"': {}, '[{"name":"a"}]': {},
    }
    frame = spark.createDataFrame([(n, r, "", "", []) for n, r in enumerate(raws)],
                                  "n int, raw string, gtin string, validation_status string, reasons array<string>")
    laid = publish.layout(frame, ["n"])
    got = {r["n"]: {c: r[c] for c in publish.LAYOUT if r[c]} for r in laid.collect()}
    assert got == dict(enumerate(raws.values()))
    plan = laid._jdf.queryExecution().optimizedPlan()
    # One parse for all records; the lookups by path stand in a lambda inside a branch.
    projected = [e for e in str(plan.treeString()).split("\n") if "_record" in e]
    assert projected and not any("variant_get" in e.split(" AS _record")[0] for e in projected if " AS _record" in e)
    assert any("from_json" in e and " AS _record" in e for e in projected)


def test_a_record_is_parsed_again_only_where_its_shape_asks_for_it(spark):
    """Three more parses of every record stood in ORs, where Spark shares and runs them."""
    raws = {
        '{"company_detail":{"name":"x"},"mrp":[{"mrp":1}],"weights_and_measures":{}}': (True, True, True), '{}': (True, True, True),
        '{"company_detail":"x","mrp":{},"weights_and_measures":[]}': (False, False, False),
        '{"company_detail":{},"mrp":[1,{"mrp":1}]}': (True, False, True), '{"mrp":[],"company_detail":1}': (False, True, True),
    }
    frame = spark.createDataFrame([(n, r) for n, r in enumerate(raws)], "n int, raw string")
    shapes = normalize.read_fields(frame, ["n"]).select("n", "ok_company", "ok_mrp", "ok_measures")
    assert {r["n"]: tuple(r)[1:] for r in shapes.collect()} == dict(enumerate(raws.values()))
    assert "OR isnull(from_json" not in shapes._jdf.queryExecution().optimizedPlan().treeString()


@pytest.mark.parametrize("key", ["validate_products", "stream_validate", "stream_monitor", "stream_idempotency",
                                 "delivery_release", "day_run_totals", "run_health", "id_list_coverage", "existing_ids",
                                 "coverage_missing", "coverage_missing_sample", "coverage_extra", "backfill_new_items", "idempotency_insert",
                                 "verdicts_for_last_day", "verdicts_on_days", "verdicts_in_run_window", "backfill_window_scan", "stream_finalize", "stream_stalls", "stream_metrics", "source_growth", "daily_verdict_csv",
                                 "publish_layout_file", "run_results_file", "daily_summary_file",
                                 "run_report_file", "page_event_log", "continuity_verdict", "monitor_summary_file", "monitor_arrivals_file", "publish_chunks", "publish_chunks_file", "delivery_payload", "delivery_payload_file", "id_list_coverage_last_day", "run_report", "daily_summary", "publish_layout", "upsert_latest_verdict", "publish_dedup", "publish_slots",
                                 "resumable_run", "coverage_summary", "run_stalls", "monitor_summary", "stream_upsert",
                                 "stream_run_counters", "backfill_totals", "reason_frequency", "outbox_transition"])
def test_query_matches_sql(spark, key):
    line = check.compare(spark, check.connect(SF), key, catalog.QUERIES[key], catalog.ORACLE[key], SF)
    assert line.startswith("OK"), line


def test_every_click_and_purchase_is_a_fetch(spark, tmp_path):
    rows = [(1, "2024-01-01 00:00:00", 7, "click", 5.0), (2, "2024-01-01 00:01:00", 7, "view", 5.0),
            (3, "2024-01-01 00:02:00", 7, "purchase", 5.0), (4, "2024-01-02 00:00:00", 8, "error", 5.0)]
    spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/events.parquet")
    got = catalog.QUERIES["monitor_fetches"](spark, str(tmp_path)).collect()
    assert sorted((r["event_id"], r["items"], r["total_fetched"]) for r in got) == [(1, 1, 1), (3, 1, 2)]


def test_reading_ids_of_pages_parses_each_page_once(spark):
    rows = [('{"runId":"r","batchId":1,"fromDate":"2024-01-01","payload":{"items":[{"gtin":" 1 "},{"GTIN":2.50},{"gtin":null,"GTIN_number":"3"},null,'
             '{"gtin":""}]}}',), ("no page {",), ('{"runId":"r","batchId":2,"payload":{"items":[]}}',), ("[1]",)]
    got = feed.page_ids(spark.createDataFrame(rows, "value string"))
    assert sorted((r["item_pos"], r["gtin"]) for r in got.collect()) == [(1, "1"), (2, "2.5"), (3, "3"), (4, None), (5, None)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.split("\n") if "Filter" in line and "from_json" in line]


def test_queries_on_runs_alone_validate_nothing(spark, monkeypatch):
    from tallyline.plans import stores

    monkeypatch.setattr(stores, "_paths", {})
    for key in ("resumable_run", "checkpoint_or_last_batch", "continuity_verdict"):
        catalog.QUERIES[key](spark, "/root/testdata/sf0.001").collect()
    assert not [k for k in stores._paths if k[2] == "verdicts"]


def test_landed_files_follow_the_tasks_that_read_the_table(spark, tmp_path):
    from tallyline.plans.q_streaming import _files

    spark.range(0, 1000, 1, 9).write.parquet(f"{tmp_path}/wide")
    size = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")
    try:
        assert _files(spark.read.parquet(f"{tmp_path}/wide"), 4) == 12
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", size)
    assert _files(spark.range(0, 1, 1, 1), 4) == 4


def test_payload_files_are_compressed_and_records_move_once(spark, tmp_path):
    """payloads were moved twice and written as plain texts."""
    rows = spark.createDataFrame([(f"r{n % 3}", n, "x" * 50) for n in range(60)], "run_id string, batch_id long, payload string")
    path = str(tmp_path / "out")
    outputs.write_json(rows.repartitionByRange("run_id", "batch_id"), path, ["run_id"], ["batch_id", "payload"], ["batch_id"],
                       dealt=True, compression="gzip")
    files_of = [f.name for f in (tmp_path / "out").rglob("part-*")]
    assert files_of and all(f.endswith(".gz") for f in files_of)
    back = spark.read.schema("batch_id long, payload string, run_id string").json(path)
    assert sorted(map(tuple, back.select("run_id", "batch_id").collect())) == sorted((f"r{n % 3}", n) for n in range(60))
    schema = "run_id string, batch_id long, item_pos int, raw string, gtin string, validation_status string, reasons array<string>"
    log = spark.createDataFrame([("r", 1, 1, '{"gtin":"1"}', "1", "Accepted", [])], schema)
    sent = publish.delivery_payloads(log.repartitionByRange("run_id", "batch_id"))
    assert sent._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("Exchange ") == 1


def test_stored_tables_are_compressed_and_leave_no_shuffles(spark, monkeypatch):
    """The texts of records and pages took most of the disk, beside the shuffles of every table before."""
    from tallyline.plans import stores
    from tallyline.session import shuffles_removed

    monkeypatch.setattr(stores, "_paths", {})
    pages = stores.store(spark, SF, "landed_pages")
    assert {"products", "batch_events", "landed_pages"} <= {k[2] for k in stores._paths}
    assert all(f.endswith(".zstd.parquet") for f in pages.inputFiles())
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    with shuffles_removed(spark):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key, None) == before


def test_scanned_pages_land_compressed(spark):
    """the pages were written as plain texts."""
    from tallyline.plans import q_validation

    pages = q_validation.landed(spark, SF)
    assert pages.inputFiles() and all(f.endswith(".gz") for f in pages.inputFiles())


def test_streamed_pages_land_as_they_are_read(spark, tmp_path):
    """all pages were moved by their text before they landed."""
    from tallyline.plans.q_streaming import _land

    texts = lambda parts: spark.range(0, 90, 1, parts).select(F.col("id").cast("string").alias("value"))
    assert _land(texts(9), f"{tmp_path}/nine") == 5 and _land(texts(1), f"{tmp_path}/one") == 2
    first = next(f for f in (tmp_path / "nine").glob("part-00000*"))
    assert first.name.endswith(".gz") and sorted(r[0] for r in spark.read.text(str(first)).collect()) == sorted(map(str, range(10)))
    assert spark.read.text(f"{tmp_path}/one").count() == 90


def test_small_files_of_many_groups_are_written_by_many_tasks(spark, tmp_path):
    """ranges were put together by their bytes, and one task wrote the files of all runs."""
    rows = spark.range(0, 40, 1, 1).select(F.col("id").alias("run"), F.col("id").alias("n"))
    outputs.write_json(rows, str(tmp_path / "out"), ["run"], ["n"], tasks=4)
    written = list((tmp_path / "out").rglob("part-*"))
    assert len(written) == 40 and len({f.name[:10] for f in written}) == 4
    assert spark.read.schema("n long").option("recursiveFileLookup", "true").json(str(tmp_path / "out")).count() == 40
