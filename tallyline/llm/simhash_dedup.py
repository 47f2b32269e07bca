"""SimHash near-dedup by an inverted index over the bytes of the fingerprints.

Two 64-bit fingerprints that differ in at most 4 bits share at least 4 of their 8 bytes at the same places. The index
lists fingerprints under bytes and their places. A list under one byte would hold 1/256 of the corpus, so a list is kept
for three places together; the 20 triples of places are chosen so that any 4 shared places contain one (a Turan
system), and no pair is missed. In a list the shared positional bytes of each pair are tallied, pairs below 4 are
dropped, and the rest is verified by its differing bits. Each list hands on a spanning star of the links it found,
never all its pairs. Lists too long for one task are compared block against block in tasks of their own.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import NULL_ID, components_in_task, materialize, partitions, prepare, table
from tallyline.llm.components import components

SHINGLE, SEED, MAX_BITS = 4, 42, 4
SHARED = 8 - MAX_BITS
# Longer lists are cut into blocks of BLOCK rows.
LIST, BLOCK = 512, 1024


def byte_triples() -> list[tuple[int, int, int]]:
    """Triples of the 8 places such that any 4 places contain one: with the places in three classes, the triples inside
    a class and those with two places of a class and one of the next."""
    classes = [(0, 1, 2), (3, 4, 5), (6, 7)]
    inside = [t for c in classes for t in combinations(c, 3)]
    return inside + [(*two, one) for k, c in enumerate(classes) for two in combinations(c, 2) for one in classes[(k + 1) % 3]]


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned fingerprint: a bit is set if it is set in over half the shingles' hashes; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        parts = [joined]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-shingle] + 1])
        parts = [joined[a:b] for a, b in zip(starts.tolist(), ends[shingle - 1:].tolist(), strict=True)]
    hashed = np.array([xxhash.xxh64_intdigest(p, SEED) for p in parts], dtype="<u8")
    bits = np.unpackbits(hashed.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = np.add.reduce(bits, axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(parts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    prepare(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


def linked(a: np.ndarray, b: np.ndarray, bits: int = MAX_BITS) -> np.ndarray:
    """Count filter, then verification, of pairs of unsigned fingerprints."""
    x = np.ascontiguousarray(a ^ b)
    shared = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    out = shared >= 8 - bits
    out[out] = np.bitwise_count(x[out]) <= bits
    return out


def _stars(ids: np.ndarray, a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    """Spanning stars (member, centre) of the links between rows a and b."""
    label = components_in_task(len(ids), np.concatenate(a), np.concatenate(b)) if a else np.arange(len(ids))
    member = np.flatnonzero(label != np.arange(len(ids)))
    return pa.RecordBatch.from_arrays([pa.array(ids[member]), pa.array(ids[label[member]])], ["a", "b"])


def _short_lists(bits: int):
    """Compare within the lists of a sorted stream: row i with row i + 1, i + 2, ... while both are of one list."""
    def links(key: np.ndarray, fp: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        a, b, at = [], [], np.arange(len(key))
        for step in range(1, len(key)):
            at = at[at + step < len(key)]
            at = at[key[at] == key[at + step]]
            if not len(at):
                break
            found = at[linked(fp[at], fp[at + step], bits)]
            if len(found):
                a.append(found)
                b.append(found + step)
        return _stars(ids, a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        rows = 0
        for batch in batches:
            held.append([batch.column(c).to_numpy() for c in ("key", "fp", "id")])
            rows += batch.num_rows
            if rows < 50_000:
                continue
            key, fp, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            last = int(np.searchsorted(key, key[-1]))  # the last list may go on
            yield links(key[:last], fp[:last].view(np.uint64), ids[:last])
            held, rows = [[key[last:], fp[last:], ids[last:]]], len(key) - last
        if held:
            key, fp, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            yield links(key, fp.view(np.uint64), ids)

    return run


def _block_pair(bits: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        left = np.flatnonzero(rows["block"] == rows["lo"])
        right = np.flatnonzero(rows["block"] == rows["hi"])
        fp, ids = rows["fp"].to_numpy().view(np.uint64), rows["id"].to_numpy()
        a, b = [], []
        for i in left:
            found = right[linked(np.full(len(right), fp[i]), fp[right], bits)]
            a.append(np.full(len(found), i))
            b.append(found)
        return _stars(ids, a, b).to_pandas()

    return run


def links(fps: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """(id, fp), each fp once -> (a, b) ids of linked fingerprints, enough of them to connect all that are linked."""
    spark = fps.sparkSession
    byte = lambda p: F.shiftrightunsigned("fp", 8 * p).bitwiseAND(255)
    keys = [F.lit(i * 2**24) + byte(x) + byte(y) * 256 + byte(z) * 65536 for i, (x, y, z) in enumerate(byte_triples())]
    postings = fps.select("id", "fp", F.explode(F.array(*keys)).alias("key"))
    long = materialize(postings.groupBy("key").count().where(F.col("count") > LIST).withColumn(
        "blocks", F.ceil(F.col("count") / BLOCK).cast("int")).drop("count"), "long-lists")
    short = postings.join(long, "key", "left_anti").repartition(partitions(spark), "key").sortWithinPartitions("key", "fp")
    found = short.select("key", "fp", "id").mapInArrow(_short_lists(bits), "a long, b long")
    blocks = postings.join(long, "key").withColumn("block", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    paired = blocks.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
    return found.unionByName(paired.select("key", "lo", "hi", "block", "fp", "id").groupBy("key", "lo", "hi").applyInPandas(
        _block_pair(bits), "a long, b long"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) for every row: the smallest doc_id that links of at most ``bits`` differing bits reach.

    Texts without words have fingerprint 0 and are linked like others. A null doc_id counts as the smallest id and makes
    its component's id null. Repeated rows and equal fingerprints are one node of the links. Further columns are not
    looked at; an empty table gives an empty result.
    """
    rows = materialize(fingerprints(docs, shingle), "fingerprints")
    ids = F.coalesce("doc_id", F.lit(NULL_ID))
    nodes = materialize(rows.groupBy("fp").agg(F.min(ids).alias("id")), "distinct-fingerprints")
    found = components(materialize(links(nodes, bits), "fingerprint-links"))
    named = materialize(nodes.join(found, F.col("id") == F.col("node"), "left").select(
        "fp", F.coalesce("component", "id").alias("component")), "fingerprint-components")
    return rows.join(named, "fp").select(
        "doc_id", "fp", F.when(F.col("component") != NULL_ID, F.col("component")).alias("component_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
