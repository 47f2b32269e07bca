"""Small helpers of this subpackage: tables, shared files, graphs inside one task."""

from __future__ import annotations

import os
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.session import materialize, scratch_path

# ASCII white space that separates words: space and the codes 9 to 13.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
# Null ids take part in comparisons as the smallest id.
NULL_ID = -(2**63)

__all__ = ["NULL_ID", "SPACES", "WORD", "components_in_task", "fresh", "full_address", "hash01", "materialize", "partitions", "scratch_path", "prepare",
           "shared_fs", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def full_address(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme and the store that Spark resolves it to, for code outside of Spark's own readers and writers."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    store = hadoop.FileSystem.getDefaultUri(spark._jsc.hadoopConfiguration())
    return hadoop.Path(path).makeQualified(store, hadoop.Path("/")).toString()


# Spark's names of stores that the readers and writers in tasks know by another name.
_SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs"}


def shared_fs(uri: str):
    """(file system, path) of a full address in the shared store, for the driver and for tasks."""
    from pyarrow import fs

    scheme, colon, rest = uri.partition(":")
    if not colon:
        raise ValueError(f"{uri} names no store: resolve it with full_address")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(f"{_SCHEMES.get(scheme, scheme)}:{rest}")


def components_in_task(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable row number of each of ``n`` rows under the links a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    return label


def hash01(*cols) -> F.Column:
    """A number strictly between 0 and 1 from the text of ``cols``; 52 bits of an MD5 digest."""
    text = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"),
                                         F.lit("null")) for c in cols])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)


def prepare(spark: SparkSession, rows: int = 1000) -> None:
    """Make a session fit for Python tasks: few rows in an Arrow batch, as texts of a batch must fit a worker's memory,
    long ones too, and the folder of this package on the workers' path, as the driver has it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    root = str(Path(__file__).resolve().parents[2])
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
