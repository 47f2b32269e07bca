"""Uniform shuffle of rows into shards of exact sizes.

How many rows each input partition sends to each shard is drawn first: a matrix with the partitions' row counts as
row sums and the shard sizes as column sums, distributed like the counts of a uniform permutation (multivariate
hypergeometric). Each partition then permutes its rows and deals them by its line of the matrix, the rows are
exchanged, and each shard permutes what it has received. The driver only handles the matrix of counts.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.llm.common import materialize, partitions, table

SHARDS = 8
SEED = 20


def hypergeometric(rng: np.random.Generator, good: int, total: int, draws: int) -> int:
    """Good ones among ``draws`` from ``total``, exact for populations of any size: the mass function is built outwards
    from its mode, over 12 standard deviations each way, and inverted."""
    low, high = max(0, draws - (total - good)), min(good, draws)
    if low == high:
        return low
    mode = min(high, max(low, (draws + 1) * (good + 1) // (total + 2)))
    p = good / total
    spread = int(12 * math.sqrt(draws * p * (1 - p) * (total - draws) / max(1, total - 1)) + 30)
    a, b = max(low, mode - spread), min(high, mode + spread)
    k = np.arange(a, b, dtype=np.float64)
    ratio = np.log(good - k) + np.log(draws - k) - np.log(k + 1) - np.log(total - good - draws + k + 1)
    mass = np.concatenate([[0.0], np.cumsum(ratio)])
    mass = np.exp(mass - mass.max())
    return a + int(np.searchsorted(np.cumsum(mass) / mass.sum(), rng.random(), side="right").clip(0, b - a))


def communication_matrix(rows: list[int], shards: list[int], seed: int) -> np.ndarray:
    """How many of each partition's ``rows`` go to each shard; both sums are met exactly."""
    rng = np.random.default_rng(seed)
    left, out = list(shards), np.zeros((len(rows), len(shards)), dtype=np.int64)
    for i, n in enumerate(rows):
        pool, need = sum(left), n
        for j, size in enumerate(left):
            got = hypergeometric(rng, size, pool, need) if need else 0
            out[i, j], pool, need = got, pool - size, need - got
            left[j] = size - got
    return out


def shard_rows(df: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``df`` with ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard) after a uniform shuffle.

    Shard sizes differ by one row at most. Rows are told apart by their place, so nulls, ties and repeated rows are
    dealt like any others; an empty table stays empty. Input columns named shard or slot are replaced. The rows are
    written once to the shared folder before they are dealt, so that a repeated task deals them alike.
    """
    spark = df.sparkSession
    names = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    data = F.struct(*[F.col(f"`{c}`") for c in names])
    rows = materialize(df.select(data.alias("data"), F.spark_partition_id().alias("part"),
                                 F.monotonically_increasing_id().alias("pos")), "shard-rows")
    counts = sorted((r["part"], r["count"]) for r in rows.groupBy("part").count().collect())  # one number a partition
    total = sum(n for _, n in counts)
    sizes = [total // shards + (j < total % shards) for j in range(shards)]
    matrix = communication_matrix([n for _, n in counts], sizes, seed)
    ends = spark.createDataFrame([(p, [int(x) for x in np.cumsum(line)]) for (p, _), line in zip(counts, matrix, strict=True)],
                                 "part int, ends array<long>")
    first = F.xxhash64(F.lit(seed), F.lit("deal"), "pos")
    second = F.xxhash64(F.lit(seed), F.lit("settle"), "pos")
    dealt = (
        rows.withColumn("n", F.row_number().over(Window.partitionBy("part").orderBy(first, "pos")))
        .join(ends, "part")
        .withColumn("shard", F.size(F.filter("ends", lambda x: x < F.col("n"))).cast("int"))
        .select("data", "shard", "pos", second.alias("order"))
    )
    # The second permutation sorts a shard by a hash; ranges of the hash are numbered apart.
    pieces = max(4, partitions(spark) // 2)
    dealt = dealt.withColumn("piece", F.floor((F.shiftrightunsigned("order", 11) / float(2**53)) * pieces)).withColumn(
        "order", F.shiftrightunsigned("order", 1))
    dealt = materialize(dealt, "shard-dealt")
    starts = dealt.groupBy("shard", "piece").count().select("shard", "piece", F.coalesce(F.sum("count").over(
        Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    own = F.row_number().over(Window.partitionBy("shard", "piece").orderBy("order", "pos"))
    return dealt.withColumn("own", own).join(starts, ["shard", "piece"]).select(
        "data.*", "shard", (F.col("start") + F.col("own") - 1).alias("slot"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The law ``rows`` holds: row counts differ by one at most. Nothing is kept together: rows with equal texts are
    shuffled like all others."""
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    return shard_rows(rows).select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                                   F.lit(None).cast("int").alias("grown_shard"))
