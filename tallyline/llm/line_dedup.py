"""Line deduplication by a sharded minimal perfect hash over the distinct line hashes.

Lines are known by 128-bit hashes of their keys. The distinct ones are dealt into shards by their hash, and each shard
gets a minimal perfect hash: bit arrays by level, in which a key sits at the first level where it has a place for
itself; the number of bits set before it is its index into the arrays of the shard (a 64-bit fingerprint, the number
of documents, the smallest doc_id). Documents send the hashes of their lines to the shards and probe the arrays; lines
are never joined with lines. A shard that gets many probes, as one very common line gives it, is copied for pieces of
them, cut by document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.llm.common import NULL_ID, SPACES, fresh, materialize, partitions, prepare, table

MIN_CHARS, MIN_DOCS = 10, 2
SHARD_KEYS = 2**16
# Bits of a level for each key that it gets.
GAMMA = 2.0


def line_keys(text: str | None, min_chars: int = MIN_CHARS) -> list[bytes | None]:
    """The hash of each line's key; None for lines whose key is too short to count."""
    keys = [line.strip(SPACES) for line in (text or "").split("\n")]
    return [xxhash.xxh3_128_digest(k.encode().lower()) if len(k) >= min_chars else None for k in keys]


def _spread(keys: np.ndarray, level: int) -> np.ndarray:
    x = keys ^ np.uint64(0x9E3779B97F4A7C15 * (level + 1) % 2**64)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53) >> np.uint64(16)


def build_hash(keys: np.ndarray) -> tuple[list[int], np.ndarray]:
    """(bits of each level, all bits) of distinct 64-bit keys."""
    sizes, arrays = [], []
    while len(keys):
        size = max(64, int(GAMMA * len(keys)))
        at = (_spread(keys, len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        arrays.append(alone)
        keys = keys[~alone[at]]
    return sizes, np.concatenate(arrays) if arrays else np.zeros(0, dtype=bool)


def probe_hash(sizes: list[int], bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Index of each key, unique from 0 for the keys it was built from; -1 for some of the others, any index for the rest."""
    rank = np.cumsum(bits) - bits
    out, left, base = np.full(len(keys), -1), np.arange(len(keys)), 0
    for level, size in enumerate(sizes):
        at = base + (_spread(keys[left], level) % np.uint64(size)).astype(np.int64)
        hit = bits[at]
        out[left[hit]] = rank[at[hit]]
        left, base = left[~hit], base + size
    return out


def _build_shard(rows: pd.DataFrame) -> pd.DataFrame:
    keys = rows["h1"].to_numpy().view(np.uint64)
    keep = np.sort(np.unique(keys, return_index=True)[1])
    rows, keys = rows.iloc[keep], keys[keep]
    sizes, bits = build_hash(keys)
    order = np.argsort(probe_hash(sizes, bits, keys))
    pick = rows.iloc[order]
    return pd.DataFrame({"shard": [int(rows["shard"].iloc[0])], "levels": [sizes], "bits": [np.packbits(bits).tobytes()],
                         "fingerprints": [pick["h2"].to_numpy().astype("<i8").tobytes()],
                         "counts": [pick["docs"].to_numpy().clip(0, 2**32 - 1).astype("<u4").tobytes()],
                         "first": [pick["first"].to_numpy().astype("<i8").tobytes()]})


def _probe_shard(min_docs: int):
    def run(probes: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        if not len(probes) or not len(shard):
            return pd.DataFrame({"id": [], "h1": []}).astype("int64")
        s = shard.iloc[0]
        sizes = [int(x) for x in s["levels"]]
        bits = np.unpackbits(np.frombuffer(s["bits"], dtype=np.uint8), count=sum(sizes)).astype(bool)
        marks, counts, first = (np.frombuffer(s[c], t) for c, t in (("fingerprints", "<i8"), ("counts", "<u4"), ("first", "<i8")))
        at = probe_hash(sizes, bits, probes["h1"].to_numpy().view(np.uint64))
        drop = (at >= 0) & (marks[at] == probes["h2"]) & (counts[at] >= min_docs) & (first[at] != probes["id"])
        return probes.loc[drop, ["id", "h1"]]

    return run


def _line_hashes(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, digests = [], []
            for i, t in zip(b.column("id").to_pylist(), b.column("text").to_pylist(), strict=True):
                found = {k for k in line_keys(t, min_chars) if k}
                digests += found
                ids += [i] * len(found)
            h = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(h[:, 0]), pa.array(h[:, 1])], ["id", "h1", "h2"])

    return run


def build_index(hashes: DataFrame) -> DataFrame:
    """(id, h1, h2) -> one row of arrays for each shard. ``counts`` has documents, 1 where all have the same id."""
    spark = hashes.sparkSession
    keys = materialize(hashes.groupBy("h1", "h2").agg(
        F.min("id").alias("first"), F.when(F.min("id") == F.max("id"), 1).otherwise(F.count("*")).alias("docs")), "line-keys")
    shards = max(4 * partitions(spark), -(-keys.count() // SHARD_KEYS))
    sharded = keys.withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int"))
    index = sharded.groupBy("shard").applyInPandas(
        _build_shard, "shard int, levels array<int>, bits binary, fingerprints binary, counts binary, first binary")
    return materialize(index.withColumn("shards", F.lit(shards)), "line-index")


def repeated_lines(hashes: DataFrame, index: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """(id, h1) of the lines that their document has to lose."""
    head = index.select("shards").first()
    shards = head["shards"] if head else 1
    probes = hashes.withColumn("shard", F.pmod("h1", F.lit(shards)).cast("int"))
    counts = materialize(probes.groupBy("shard").count(), "line-probes")
    most = F.greatest(F.lit(256), 2 * F.sum("count").over(Window.partitionBy()) / shards)
    pieces = materialize(counts.select("shard", F.ceil(F.col("count") / most).cast("int").alias("pieces")), "line-pieces")
    dealt = probes.join(pieces, "shard").withColumn("piece", F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int")).drop("pieces")
    copies = index.join(pieces, "shard").withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).drop("pieces", "shards")
    return dealt.groupBy("shard", "piece").cogroup(copies.groupBy("shard", "piece")).applyInPandas(_probe_shard(min_docs), "id long, h1 long")


def drop_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with its texts without the repeated lines, and with ``n_lines`` and ``n_dropped`` (input columns of these
    names are replaced).

    A line that is in several documents stays in the one with the smallest doc_id, there as often as it is written. A
    null doc_id counts as the smallest id; rows with equal doc_ids are one document for the count, and all of them keep
    its lines. A null text has one empty line and stays null. Lines of a short key always stay.
    """
    spark = docs.sparkSession
    prepare(spark)
    base = docs.drop("n_lines", "n_dropped")
    names = base.columns
    key, lost = fresh(base, "_line_id"), fresh(base, "_lost")
    base = base.withColumn(key, F.coalesce("doc_id", F.lit(NULL_ID)))
    hashes = base.select(F.col(key).alias("id"), "text").mapInArrow(_line_hashes(min_chars), "id long, h1 long, h2 long")
    hashes = materialize(hashes, "line-hashes")
    repeated = repeated_lines(hashes, build_index(hashes), min_docs)
    by_doc = materialize(repeated.groupBy("id").agg(F.collect_set("h1").alias(lost)), "lost-lines").withColumnRenamed("id", key)
    text_at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, lines, dropped = [], [], []
            for t, gone in zip(b.column(text_at).to_pylist(), b.column(len(names)).to_pylist(), strict=True):
                lines.append((t or "").count("\n") + 1)
                if gone:
                    parts = t.split("\n")
                    gone = set(gone)
                    keep = [p for p, k in zip(parts, line_keys(t, min_chars), strict=True)
                            if k is None or int.from_bytes(k[:8], "little", signed=True) not in gone]
                    dropped.append(len(parts) - len(keep))
                    t = "\n".join(keep)
                else:
                    dropped.append(0)
                texts.append(t)
            columns = [b.column(i) for i in range(len(names))]
            columns[text_at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())], [*names, "n_lines", "n_dropped"])

    joined = base.join(by_doc, key, "left").select(*[F.col(f"`{c}`") for c in names], lost)
    schema = docs.drop("n_lines", "n_dropped").schema.add("n_lines", "long").add("n_dropped", "long")
    return joined.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n FROM documents),
k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (first <> doc_id)::BIGINT AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (first IS NULL OR first = doc_id), '')) AS kept_sha256
FROM k LEFT JOIN r USING (key) GROUP BY doc_id
"""
