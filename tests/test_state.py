"""State tables of streams: buckets, replay, restart, what a batch reads and writes."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tallyline.operators import verdict_store
from tallyline.session import scratch_path
from tallyline.sinks import buckets, files
from tallyline.streaming import jobs

SCHEMA = "gtin string, created_at timestamp_ntz, batch_id long, item_pos int, validation_status string"


def at(n):
    return dt.datetime(2026, 1, 1) + dt.timedelta(minutes=n)


def land(spark, rows, path, schema=SCHEMA, per_batch=1):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(spark.createDataFrame([], schema).schema).option("maxFilesPerTrigger", per_batch).parquet(path)


def pieces(spark, root):
    """{folder/bucket: bytes} of all pieces under a table."""
    found = {}
    for v in files.folders(spark, f"{root}/pieces", "v="):
        found |= {f"{v}/{b}": n for b, n in files.folders(spark, f"{root}/pieces/v={v}", "bucket=").items()}
    return found


def test_upserts_write_what_the_batch_needs(spark):
    path, root, check = (scratch_path(spark, n) for n in ("in", "current", "checkpoint"))
    big = [(f"id{i}", at(i % 50), 1, i, "Rejected") for i in range(20_000)]
    jobs.upsert_current(land(spark, big, path), root, check, 32).awaitTermination()
    whole = sum(pieces(spark, root).values())
    rows, written = list(big), []
    for n in range(6):  # repeated ids, new ones, and rows older than what is stored
        batch = [(f"id{n}", at(900 + n), 2 + n, 0, "Accepted"), (f"id{n}", at(900 + n), 2 + n, 1, "Rejected"),
                 (f"id{n + 100}", at(-5), 2 + n, 2, "Accepted"), (f"new{n % 3}", at(n), 2 + n, 3, "Accepted")]
        rows += batch
        before = pieces(spark, root)
        jobs.upsert_current(land(spark, batch, path), root, check, 32).awaitTermination()
        after = pieces(spark, root)
        written.append(sum(n for k, n in after.items() if k not in before))
        assert len([k for k in after if k not in before]) <= 6
    assert max(written) < whole / 10
    table = jobs.current_table(spark, root, 32)
    want = verdict_store.latest(spark.createDataFrame(rows, SCHEMA)).orderBy("gtin").collect()
    assert table.read().select(*SCHEMA_COLUMNS).orderBy("gtin").collect() == want
    one = table.touched(spark.createDataFrame([("new1",)], "gtin string"))
    assert [r["batch_id"] for r in table.read(one).filter("gtin = 'new1'").collect()] == [6]
    assert len(files.folders(spark, f"{root}/versions", "", ".json")) == buckets.KEEP


SCHEMA_COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


def test_pieces_of_a_bucket_stay_few(spark):
    root = scratch_path(spark, "state")
    table = buckets.BucketTable(spark, root, "gtin", verdict_store.latest, 1)
    for n in range(12):
        table.add(spark.createDataFrame([(f"g{i}", at(n), n, 0, str(n)) for i in range(n * 40, n * 40 + 60)], SCHEMA), "s", n)
    listed = table.version()["buckets"]["0"]
    assert len(listed) <= 5 and [p["bytes"] for p in listed] == sorted((p["bytes"] for p in listed), reverse=True)
    assert table.read().count() == 11 * 40 + 60
    assert table.read().filter("gtin = 'g45'").first()["validation_status"] == "1"


def test_a_batch_that_fails_or_comes_again_counts_once(spark, monkeypatch):
    path, root, check = (scratch_path(spark, n) for n in ("in", "current", "checkpoint"))
    stream = land(spark, [("a", at(1), 1, 1, "Rejected")], path)
    jobs.upsert_current(stream, root, check).awaitTermination()
    pointed = buckets.replace_text

    def fails(spark, place, text):
        if place.endswith("/current"):
            raise RuntimeError("the driver is lost before the version counts")
        pointed(spark, place, text)

    stream = land(spark, [("a", at(2), 2, 1, "Accepted"), ("b", at(2), 2, 2, "Accepted")], path)
    monkeypatch.setattr(buckets, "replace_text", fails)
    with pytest.raises(Exception, match="lost before"):
        jobs.upsert_current(stream, root, check).awaitTermination()
    read = lambda: sorted((r["gtin"], r["validation_status"]) for r in jobs.current_table(spark, root).read().collect())
    assert read() == [("a", "Rejected")]
    monkeypatch.setattr(buckets, "replace_text", pointed)
    jobs.upsert_current(stream, root, check).awaitTermination()
    assert read() == [("a", "Accepted"), ("b", "Accepted")]
    number = jobs.current_table(spark, root).version()["number"]
    table = jobs.current_table(spark, root)
    assert table.add(spark.createDataFrame([("a", at(9), 9, 9, "x")], SCHEMA), next(iter(table.version()["batches"])), 1) is False
    # A checkpoint begun anew reads all files again: other batches, equal rows.
    jobs.upsert_current(stream, root, scratch_path(spark, "checkpoint")).awaitTermination()
    assert read() == [("a", "Accepted"), ("b", "Accepted")] and table.version()["number"] > number
    assert not [f for f in os.listdir(root) if f.startswith("current.")]


def test_an_empty_batch_and_null_ids(spark):
    root = scratch_path(spark, "state")
    table = jobs.current_table(spark, root, 4)
    assert table.read() is None
    table.add(spark.createDataFrame([], SCHEMA), "s", 0)
    assert table.read().count() == 0
    table.add(spark.createDataFrame([(None, at(1), 1, 1, "a"), (None, at(2), 1, 1, "b"), ("", at(1), 1, 1, "c")], SCHEMA), "s", 1)
    assert sorted((r["gtin"], r["validation_status"]) for r in table.read().select("*", F.lit(1)).collect() if r["gtin"] is not None) == [("", "c")]
    assert table.read().filter("gtin IS NULL").first()["validation_status"] == "b"


def test_counts_are_compacted_and_close_their_runs(spark):
    path, root, check = (scratch_path(spark, n) for n in ("in", "counters", "checkpoint"))
    schema = "run_id string, validation_status string, schema_valid boolean"
    for n in range(5):
        rows = [("r1", "Accepted", True), ("r1", "Rejected", False)] + [("r2", "Rejected", True)] * (n == 0) + [("r3", "Accepted", True)] * 2
        jobs.run_counters(land(spark, rows, path, schema), root, check, 2).awaitTermination()
    got = sorted(tuple(r) for r in jobs.newest_counts(spark, root, 2).collect())
    assert got == [("r1", 10, 5, 0, 5), ("r2", 1, 0, 1, 0), ("r3", 10, 10, 0, 0)]
    assert all(len(p) <= 3 for p in jobs.counter_table(spark, root, 2).version()["buckets"].values())
    runs = spark.createDataFrame([("r1", "RUNNING", True, 10), ("r2", "RUNNING", True, 2), ("r3", "RUNNING", False, 10), ("r4", "FAILED", True, 0), ("r5", "RUNNING", True, 0)],
                                 "run_id string, status string, ingestion_completed boolean, items_fetched long").withColumn("end_time", F.lit(None).cast("timestamp_ntz"))
    done = jobs.finalize(spark, root, runs, F.lit("2026-01-01 00:00:00").cast("timestamp_ntz"), 2).collect()
    assert {r["run_id"]: (r["status"], r["validated_count"], r["end_time"] is not None) for r in done} == {
        "r1": ("SUCCESS", 10, True), "r2": ("RUNNING", 1, False), "r3": ("RUNNING", 10, False), "r4": ("FAILED", 0, False), "r5": ("SUCCESS", 0, True)}


def test_a_batch_of_keys_reads_its_own_buckets(spark, monkeypatch):
    path, root, check = (scratch_path(spark, n) for n in ("keys", "delivered", "checkpoint"))
    schema = "idempotency_key string, delivered_at timestamp"
    at_ = lambda n: dt.datetime(2026, 1, 1, tzinfo=dt.UTC) + dt.timedelta(minutes=n)
    jobs.first_deliveries(land(spark, [(f"k{i}", at_(i)) for i in range(2000)], path, schema), root, check, 32).awaitTermination()
    read, opened = buckets.BucketTable._rows, []
    monkeypatch.setattr(buckets.BucketTable, "_rows", lambda t, v, pieces: (opened.extend(p["path"].split("=")[-1] for p in pieces), read(t, v, pieces))[1])
    jobs.first_deliveries(land(spark, [("k7", at_(-9)), ("new", at_(1)), ("new", at_(0))], path, schema), root, check, 32).awaitTermination()
    assert 1 <= len(set(opened)) <= 2
    rows = {r["idempotency_key"]: r["delivered_at"] for r in jobs.key_table(spark, root, 32).read().collect()}
    assert len(rows) == 2001 and rows["k7"].minute == 7 and rows["new"].minute == 0


def test_stalls_of_a_stream_equal_those_of_the_table(spark):
    import random

    from tallyline.operators import monitor

    r, rows = random.Random(2), []
    for run in range(4):
        items = 0
        for n in range(90):
            items += r.random() < 0.12
            rows.append((run, run * 100 + n, at(n), items, 5, "FAILED" if r.random() < 0.03 else "RUNNING"))
    schema = "run_no long, event_id long, ts timestamp_ntz, items_fetched long, source_total long, status string"
    series = monitor.polls(spark.createDataFrame(rows, schema))
    want = sorted(tuple(x) for x in monitor.stalls(series, 10, F.min("event_id").alias("e")).select("run_no", "e", "polls").collect())
    path, out, check = (scratch_path(spark, n) for n in ("polls", "stalls", "checkpoint"))
    for part in range(5):
        mine = [x for x in rows if x[1] % 100 // 18 == part]
        df = spark.createDataFrame(mine, schema).withColumn("ts", F.col("ts").cast("timestamp")).drop("source_total")
        df.coalesce(1).write.mode("append").parquet(path)
        jobs.watch_stalls(spark.readStream.schema(df.schema).parquet(path), out, check).awaitTermination()
    got = sorted(tuple(x) for x in jobs.merged_stalls(spark, out).select("run_no", "first_event", "polls").collect())
    assert got == want and len(want) > 3 and any(e // 18 != (e + n - 1) // 18 for _, e, n in [(a, b % 100, c) for a, b, c in want])


def test_observed_counts_add_up_over_restarts(spark):
    path, root, check = (scratch_path(spark, n) for n in ("in", "log", "checkpoint"))
    schema = "gtin string, validation_status string, schema_valid boolean"
    for n in range(3):
        stream = land(spark, [("1", "Accepted", True), ("2", "Rejected", True), ("3", "Rejected", False)][:3 - n], path, schema)
        for _ in range(2):
            jobs.write_log(stream, root, check).awaitTermination()
    files.delete(spark, f"{check}/commits/2")  # the last batch comes again
    jobs.write_log(stream, root, check).awaitTermination()
    got = {x["metric"]: x["total"] for x in jobs.metric_totals(spark, root).collect()}
    assert got == {"validated": 6, "accepted": 3, "rejected": 2, "schema_invalid": 1}
    assert spark.read.parquet(f"{root}/log").count() == 6
