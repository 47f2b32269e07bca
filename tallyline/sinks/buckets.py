"""A keyed state table in hash buckets, for streams that merge small batches into a large table.

    root/pieces/v=<version>-<commit>/bucket=<n>/*.parquet   rows of one bucket
    root/versions/<version>.json                            the pieces of every bucket, newest last, and the batches in them
    root/current                                            the number of the version that counts, written last

A batch adds one piece to each bucket that its keys fall into. The pieces of a bucket stay in geometric order: a new piece takes
the rows of those before it that are not larger than itself, so a bucket of n rows has about log n pieces, what a batch
writes follows the batch and not the table, and buckets without a key of the batch are neither read nor written. A
batch that comes again is known by the name of its stream and its number, and changes nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.sinks.files import delete, exists, folders, read_text, replace_text

# Versions whose files stay, for readers that have opened an older one.
KEEP = 2


class BucketTable:
    """``merge`` makes one row of each key from rows of several batches; its result must not depend on their order."""

    def __init__(self, spark: SparkSession, root: str, key: str, merge: Callable[[DataFrame], DataFrame], buckets: int = 64):
        self.spark, self.root, self.key, self.merge_rows, self.buckets = spark, root.rstrip("/"), key, merge, buckets

    def _pieces_root(self) -> str:
        return f"{self.root}/pieces"

    def version(self) -> dict | None:
        """The version that counts: number, schema, pieces of each bucket and last batch of each stream."""
        if not exists(self.spark, f"{self.root}/current"):
            return None
        number = int(read_text(self.spark, f"{self.root}/current"))
        return json.loads(read_text(self.spark, f"{self.root}/versions/{number}.json"))

    def _rows(self, version: dict, pieces: list[dict]) -> DataFrame:
        schema = T.StructType.fromJson(version["schema"])
        if not pieces:
            return self.spark.createDataFrame([], schema.add("bucket", T.IntegerType()))
        read = self.spark.read.schema(T.StructType(schema.fields).add("v", T.StringType()).add("bucket", T.IntegerType()))
        return read.option("basePath", self._pieces_root()).parquet(*[f"{self._pieces_root()}/{p['path']}" for p in pieces]).drop("v")

    def read(self, buckets: list[int] | None = None) -> DataFrame | None:
        """One row of each key, of all buckets or of some; None before the first batch."""
        version = self.version()
        if version is None:
            return None
        chosen = [p for b, listed in version["buckets"].items() if buckets is None or int(b) in buckets for p in listed]
        return self.merge_rows(self._rows(version, chosen).drop("bucket"))

    def bucket_of(self, column: str | None = None) -> F.Column:
        return F.pmod(F.xxhash64(column or self.key), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets that hold the keys of ``rows``: as many numbers at most as there are buckets."""
        return [r[0] for r in rows.select(self.bucket_of().alias("bucket")).distinct().collect()]

    def add(self, batch: DataFrame, stream: str, batch_id: int) -> bool:
        """Merge a batch; False if this batch of this stream is already in the table."""
        version = self.version() or {"number": -1, "buckets": {}, "batches": {}}
        if version["batches"].get(stream, -1) >= batch_id:
            return False
        name = f"v={version['number'] + 1}-{uuid.uuid4().hex[:12]}"
        place = f"{self._pieces_root()}/{name}"
        arrived = self.merge_rows(batch).withColumn("bucket", self.bucket_of())
        schema = T.StructType([f for f in arrived.schema.fields if f.name != "bucket"])
        arrived.hint("rebalance", F.col("bucket")).write.partitionBy("bucket").parquet(place)
        version |= {"schema": schema.jsonValue(), "number": version["number"] + 1}
        sizes = folders(self.spark, place, "bucket=")
        absorbed: list[dict] = []
        kept: dict[str, list[dict]] = dict(version["buckets"])
        large: dict[str, list[dict]] = {}
        for bucket, size in sizes.items():
            listed, total, taken = list(kept.get(bucket, [])), size, []
            while listed and listed[-1]["bytes"] <= total:
                taken.append(listed.pop())
                total += taken[-1]["bytes"]
            kept[bucket] = listed
            if taken:
                large[bucket] = taken
                absorbed += taken
        if absorbed:  # buckets whose new piece takes older ones are written once more, with them
            merged_name = f"{name}m"
            mine = [{"path": f"{name}/bucket={b}"} for b in large]
            rows = reduce(DataFrame.unionByName, [self._rows(version, absorbed), self._rows(version, mine)])
            rows = self.merge_rows(rows.drop("bucket")).withColumn("bucket", self.bucket_of())
            rows.hint("rebalance", F.col("bucket")).write.partitionBy("bucket").parquet(f"{self._pieces_root()}/{merged_name}")
            merged = folders(self.spark, f"{self._pieces_root()}/{merged_name}", "bucket=")
        for bucket, size in sizes.items():
            folder, size = (merged_name, merged[bucket]) if bucket in large else (name, size)
            kept[bucket] = [*kept[bucket], {"path": f"{folder}/bucket={bucket}", "bytes": size}]
        version |= {"buckets": kept, "batches": version["batches"] | {stream: batch_id}}
        self._commit(version)
        return True

    def _commit(self, version: dict) -> None:
        """Write the version, point to it, and remove the files that no kept version names."""
        number = version["number"]
        replace_text(self.spark, f"{self.root}/versions/{number}.json", json.dumps(version))
        replace_text(self.spark, f"{self.root}/current", str(number))
        self._clean(number)

    def _clean(self, number: int) -> None:
        live: set[str] = set()
        for n in folders(self.spark, f"{self.root}/versions", "", ".json"):
            if int(n) > number - KEEP:
                version = json.loads(read_text(self.spark, f"{self.root}/versions/{n}.json"))
                live |= {p["path"] for listed in version["buckets"].values() for p in listed}
            else:
                delete(self.spark, f"{self.root}/versions/{n}.json")
        used = {p.split("/")[0] for p in live}
        for v in folders(self.spark, self._pieces_root(), "v="):
            if f"v={v}" not in used:
                delete(self.spark, f"{self._pieces_root()}/v={v}")
                continue
            for b in folders(self.spark, f"{self._pieces_root()}/v={v}", "bucket="):
                if f"v={v}/bucket={b}" not in live:
                    delete(self.spark, f"{self._pieces_root()}/v={v}/bucket={b}")


def stream_name(spark: SparkSession, default: str) -> str:
    """Identity of the running streaming query: it changes when its checkpoint is begun anew."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or default
