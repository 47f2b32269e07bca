"""Delivery ledger: idempotency keys, outbox records and retry times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions import dates

# First retry, growth and cap of retry delays, rows per replay.
FIRST_RETRY_MINUTES, RETRY_CAP_SECONDS, REPLAY_LIMIT = 2, 600, 50


def idempotency_key(gtin: Column, status: Column) -> Column:
    return F.sha2(F.concat(F.coalesce(gtin, F.lit("")), F.lit("|"), F.coalesce(status, F.lit(""))), 256)


def insert_keys(existing: DataFrame, arrived: DataFrame) -> DataFrame:
    """Keys not stored yet, each once, as first delivered."""
    w = Window.partitionBy("idempotency_key").orderBy("created_at", "batch_id", "item_pos")
    first = arrived.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    return first.join(existing.select("idempotency_key").distinct(), "idempotency_key", "left_anti")


def retriable(http_status: Column) -> Column:
    """No answer, too many requests, or a server error."""
    return http_status.isNull() | (http_status == 429) | http_status.between(500, 599)


def delivered(http_status: Column) -> Column:
    return F.coalesce(http_status.between(200, 299), F.lit(False))


def failure(http_status: Column) -> Column:
    return F.coalesce(F.concat(F.lit("status "), http_status.cast("string")), F.lit("no response"))


def append_outbox(attempts: DataFrame, at: str, path: str) -> None:
    """Append the failed deliveries of a run to the stored outbox."""
    enqueue_failed(attempts, at).write.mode("append").parquet(path)


def enqueue_failed(attempts: DataFrame, at: str) -> DataFrame:
    """Outbox records for failed deliveries, with what was to be sent, due two minutes after the attempt."""
    failed = attempts.filter(~delivered(F.col("http_status")))
    return failed.select("outbox_id", "run_id", "batch_id", "payload", F.lit(1).alias("attempts"), F.lit("PENDING").alias("status"),
                         (F.col(at) + dates.minutes(FIRST_RETRY_MINUTES)).alias("next_retry_at"),
                         failure(F.col("http_status")).alias("last_error"))


def due(outbox: DataFrame, now: Column, limit: int = REPLAY_LIMIT) -> DataFrame:
    """The next records to retry, earliest first."""
    ready = outbox.filter((F.col("status") == "PENDING") & (F.col("next_retry_at") <= now))
    return ready.orderBy("next_retry_at", "outbox_id").limit(limit)


def transition(outbox: DataFrame, now: Column) -> DataFrame:
    """Due records after their retry: delivered, or one more attempt after
    ``2^attempts`` seconds, at most ten minutes, with the new error."""
    is_due = (F.col("status") == "PENDING") & (F.col("next_retry_at") <= now)
    ok = delivered(F.col("http_status"))
    attempts = F.col("attempts") + 1
    delay = F.least(F.pow(F.lit(2), attempts), F.lit(RETRY_CAP_SECONDS)).cast("decimal(18,6)")
    retry_at = now + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), delay)
    return outbox.withColumns({
        "status": F.when(is_due & ok, "DELIVERED").otherwise(F.col("status")),
        "next_retry_at": F.when(is_due & ~ok, retry_at).otherwise(F.col("next_retry_at")),
        "attempts": F.when(is_due & ~ok, attempts).otherwise(F.col("attempts")),
        "last_error": F.when(is_due & ~ok, failure(F.col("http_status"))).otherwise(F.col("last_error")),
    })
