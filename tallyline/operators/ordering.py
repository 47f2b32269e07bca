"""Exact row numbers over a total order, without a single sorting task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.session import materialize


def with_position(df: DataFrame, order: list[str], name: str = "position") -> DataFrame:
    """Add the 0-based position of each row in the total order ``order``.

    Rows are range-partitioned and sorted, so partitions are balanced whatever the
    key distribution. The place inside the partition is fixed by writing the
    sorted rows once; then each partition's offset is the size of those before it
    (a table with one row per partition).
    """
    sorted_rows = df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id())
    fixed = materialize(sorted_rows, "sorted").withColumns({
        "_part": F.shiftright("_place", 33), "_row": F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))})
    sizes = fixed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    # One row per partition of the sort: bounded by the shuffle partition count.
    placed = fixed.join(F.broadcast(offsets), "_part")
    return placed.withColumn(name, F.col("_row") + F.col("_offset")).drop("_place", "_part", "_row", "_offset")
