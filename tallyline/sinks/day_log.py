"""Tables partitioned by day: a day is replaced as a whole, and a job for some days reads those only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_days(rows: DataFrame, path: str, day: str = "day") -> None:
    """Write ``rows`` into ``path/<day>=.../``. Days that ``rows`` has replace what was there, other days stay; a heavy day is
    split by size at run time, light ones share tasks."""
    rows.hint("rebalance", F.col(day)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option(
        "compression", "zstd").partitionBy(day).parquet(path)


def read_days(spark: SparkSession, path: str, first: str | None = None, last: str | None = None, day: str = "day") -> DataFrame:
    """Rows of an inclusive range of days, of one day (both alike), or of all. Folders of other days are never listed by
    the scan."""
    rows = spark.read.parquet(path)
    if first:
        rows = rows.where(F.col(day) >= F.lit(first).cast("date"))
    if last:
        rows = rows.where(F.col(day) <= F.lit(last).cast("date"))
    return rows
