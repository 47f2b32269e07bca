"""File outputs: quoted CSV by day, verdict JSON, payloads, versioned tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of the daily verdict file.
VERDICT_FILE = ["GTIN_number", "Status", "Reason", "Date"]


def verdict_rows(verdicts: DataFrame, day: str) -> DataFrame:
    """The four file columns; ``Date`` is the first ten characters of ``day``."""
    return verdicts.withColumns({
        "GTIN_number": F.coalesce("gtin", F.lit("")), "Status": F.coalesce("validation_status", F.lit("")),
        "Reason": F.array_join("reasons", "; "), "Date": F.substring(F.col(day).cast("string"), 1, 10)})


def append_daily_csv(verdicts: DataFrame, path: str, day: str) -> None:
    """Append to ``path/day=<day>/``: a bare header line once for each day, then rows, quoted, blank values too."""
    rows = verdict_rows(verdicts, day)
    quoted = [F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"')) for c in VERDICT_FILE]
    lines = rows.select(F.col("Date").alias("day"), F.lit(1).alias("n"), F.concat_ws(",", *quoted).alias("value"))
    headers = rows.select(F.col("Date").alias("day")).distinct().select(
        "day", F.lit(0).alias("n"), F.lit(",".join(VERDICT_FILE)).alias("value"))
    begun = [(d,) for d in names(verdicts.sparkSession, path, "day=")]  # a folder for each day
    if begun:
        headers = headers.join(verdicts.sparkSession.createDataFrame(begun, "day string"), "day", "left_anti")
    # Days gather into few files; a heavy day is split by size at run time.
    gathered = lines.unionByName(headers).hint("rebalance", F.col("day")).sortWithinPartitions("day", "n")
    gathered.select("day", "value").write.mode("append").partitionBy("day").text(path)


def _place(spark: SparkSession, path: str):
    """(file system, path) in the session's own terms."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _place(spark, path)
    return fs.exists(hadoop)


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop = _place(spark, path)
    fs.delete(hadoop, True)


def names(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """What follows ``prefix`` in the entries of a folder that begin with it."""
    fs, hadoop = _place(spark, path)
    found = [s.getPath().getName() for s in fs.listStatus(hadoop)] if fs.exists(hadoop) else []
    return [n.removeprefix(prefix) for n in found if n.startswith(prefix)]


def folders(spark: SparkSession, path: str, prefix: str, suffix: str = "") -> dict[str, int]:
    """Entries of a folder named ``prefix<name>suffix``: bytes by name; none where there is no folder."""
    fs, hadoop = _place(spark, path)
    if not fs.exists(hadoop):
        return {}
    found = [(s, s.getPath().getName()) for s in fs.listStatus(hadoop)]
    return {n[len(prefix):len(n) - len(suffix)]: fs.getContentSummary(s.getPath()).getLength() if s.isDirectory() else s.getLen()
            for s, n in found if n.startswith(prefix) and n.endswith(suffix)}


def read_text(spark: SparkSession, path: str) -> str:
    fs, hadoop = _place(spark, path)
    stream = fs.open(hadoop)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside its place and move it there: a reader sees the old text or the new one."""
    fs, hadoop = _place(spark, path)
    _, beside = _place(spark, f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(beside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(beside), fs.makeQualified(hadoop), options)


def write_batch_json(verdicts: DataFrame, path: str, day: str) -> None:
    """Verdicts of every batch as JSON lines by day; run and batch are columns, so
    small batches do not become small files."""
    rows = verdict_rows(verdicts, day).select("run_id", "batch_id", *VERDICT_FILE, F.col("Date").alias("day"))
    rows.hint("rebalance", F.col("day")).write.mode("append").partitionBy("day").json(path)


def write_version(df: DataFrame, root: str, version: int) -> str:
    """Write a table as ``root/version=<n>``. Rewriting the same version gives the
    same rows, so a replayed batch does no harm."""
    path = f"{root}/version={version}"
    df.write.mode("overwrite").parquet(path)
    return path


def latest_version(spark: SparkSession, root: str, prefix: str = "version=") -> int | None:
    """Highest finished version under ``root`` (one with a success marker)."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return None
    found = []
    for status in fs.listStatus(hadoop):
        name = status.getPath().getName()
        marker = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith(prefix) and fs.exists(marker):
            found.append(int(name.removeprefix(prefix)))
    return max(found, default=None)
