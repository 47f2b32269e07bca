"""Time the headline queries and print one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_KEYS (comma-separated keys, or "all") choose the
data, the cores and the queries. ``verdict_store`` is the job that validates every
record and writes the verdict log the other queries read.
"""

from __future__ import annotations

import json
import os
import time

from tallyline.plans import catalog, stores
from tallyline.session import get_session

HEADLINE = [
    "validate_products", "upsert_latest_verdict", "publish_dedup", "publish_slots", "run_counters", "daily_summary",
    "run_discrepancy", "day_run_totals", "reason_frequency", "top_duplicate_ids", "verdicts_for_day",
    "coverage_summary", "backfill_totals", "id_list_coverage", "next_run_action", "idempotency_insert",
    "outbox_transition", "monitor_summary", "run_stalls", "stream_upsert", "stream_run_counters", "publish_layout", "publish_chunks",
    "delivery_payload", "daily_verdict_csv", "batch_verdict_json", "stream_validate", "stream_monitor",
    "stream_idempotency", "delivery_release", "stream_stalls", "stream_metrics", "verdicts_for_last_day",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_KEYS", "")
    keys = list(catalog.QUERIES) if chosen == "all" else (chosen.split(",") if chosen else HEADLINE)
    spark = get_session("bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus,
                                                      "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name: str, work) -> None:
        begin = time.perf_counter()
        work()
        seconds[name] = round(time.perf_counter() - begin, 3)

    timed("verdict_store", lambda: stores.store(spark, sf_dir, "verdicts"))
    timed("run_store", lambda: [stores.store(spark, sf_dir, n) for n in ("runs", "batch_events", "checkpoints")])
    for key in keys:
        timed(key, lambda: catalog.QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save())
    spark.stop()
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
