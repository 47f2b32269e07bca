"""Near-dedup of the pipeline: texts whose sets of 5-word shingles have a Jaccard similarity of 0.8 or more.

A node is a distinct set of shingles, named by a hash of its own, so that document ids play no part in the links.
Candidates are fingerprints of 5-word shingles that differ in at most 4 bits, found by op 8's index over the bytes of
fingerprints. As a pair at 0.8 has about 10 differing bits, texts that share a band of minima of hash functions are candidates
as well (BANDS bands of ROWS: a pair at 0.8 is missed once in 10,000, a more similar one less often). Candidates are only joined to groups by spanning stars; every group is then compared exactly, large
ones block against block in tasks of their own, and only links of similarity 0.8 or more stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm import simhash_dedup
from tallyline.llm.common import fresh, materialize, partitions, prepare
from tallyline.llm.components import components

SHINGLE, SEED = 5, 42
# Similarity as a fraction, compared in whole numbers.
SIMILAR = (4, 5)
BANDS, ROWS = 40, 7
# Larger groups are cut into blocks of about BLOCK sets.
BLOCK = 512
_FACTORS = np.random.default_rng(SEED).integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the 5-word shingles; of all words together if there are fewer, none without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.array([], dtype="<u8")
    parts = {b" ".join(words[i:i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))}
    return np.sort(np.fromiter((xxhash.xxh64_intdigest(p, SEED) for p in parts), dtype="<u8", count=len(parts)))


def bands(grams: np.ndarray) -> list[int]:
    """A signed hash of each band of minima; none for an empty set."""
    if not len(grams):
        return []
    low = np.full(len(_FACTORS), 2**64 - 1, dtype=np.uint64)
    for at in range(0, len(grams), 1024):
        np.minimum(low, (_FACTORS[:, None] * grams[None, at:at + 1024]).min(axis=1), out=low)
    keys = [xxhash.xxh64_intdigest(x.tobytes(), k) for k, x in enumerate(low.reshape(BANDS, ROWS))]
    return np.array(keys, dtype=np.uint64).view(np.int64).tolist()


def _with_nodes(docs: DataFrame, node: str, keys: str, fp: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(t) for t in b.column("text").to_pylist()]
            nodes = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], dtype=np.uint64).view(np.int64)
            prints = np.array([simhash_dedup.fingerprint(t, SHINGLE) for t in b.column("text").to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(nodes), pa.array([bands(s) for s in sets], pa.list_(pa.int64())), pa.array(prints)],
                [*b.schema.names, node, keys, fp])

    prepare(docs.sparkSession)
    schema = T.StructType([*docs.schema.fields, T.StructField(node, T.LongType()), T.StructField(keys, T.ArrayType(T.LongType())),
                           T.StructField(fp, T.LongType())])
    return docs.mapInArrow(run, schema)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        grams = [shingles(t).tobytes() for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("node"), b.column("grp"), pa.array(grams, pa.binary())], ["node", "grp", "grams"])


def similar_in_task(sets: list[np.ndarray]) -> np.ndarray:
    """Label of each set: the smallest place that links of similar sets reach.

    A set is compared with all others through lists of the sets that hold each of its shingles. Sets of the smallest
    components go first, and the rest need no comparison as soon as they are one component.
    """
    n, sizes = len(sets), np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    holders = np.repeat(np.arange(n), sizes)[np.argsort(code, kind="stable")]
    lengths = np.bincount(code)
    starts = np.cumsum(lengths) - lengths
    label, todo = np.arange(n), np.ones(n, dtype=bool)
    while True:
        left = np.flatnonzero(todo)
        if not len(left) or (label[left] == label[left[0]]).all():
            return label
        i = left[np.argmin(np.bincount(label, minlength=n)[label[left]])]
        todo[i] = False
        mine = code[ends[i] - sizes[i]:ends[i]]
        count = lengths[mine]
        place = np.repeat(starts[mine] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        shared = np.bincount(holders[place], minlength=n)
        near = label[SIMILAR[1] * shared >= SIMILAR[0] * (sizes + sizes[i] - shared)]
        label[np.isin(label, near)] = near.min()


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning stars (member, centre) of the similar sets of every (grp, lo, hi) of a sorted stream."""
    def stars() -> pa.RecordBatch:
        label = similar_in_task([np.frombuffer(g, "<u8") for g in grams])
        member = np.flatnonzero(label != np.arange(len(label)))
        ids = np.array(nodes, dtype=np.int64)
        return pa.RecordBatch.from_arrays([pa.array(ids[member]), pa.array(ids[label[member]])], ["a", "b"])

    current, nodes, grams = None, [], []
    for b in batches:
        for *key, node, gram in zip(*(b.column(c).to_pylist() for c in ("grp", "lo", "hi", "node", "grams")), strict=True):
            if key != current:
                if len(nodes) > 1:
                    yield stars()
                current, nodes, grams = key, [], []
            nodes.append(node)
            grams.append(gram)
    if len(nodes) > 1:
        yield stars()


def _fingerprint_links(rows: DataFrame, node: str, keys: str, fp: str) -> DataFrame:
    """(a, b) nodes with words whose fingerprints differ in at most 4 bits, enough of them to connect all such nodes."""
    prints = materialize(rows.where(F.size(keys) > 0).select(F.col(node).alias("node"), F.col(fp).alias("fp")).distinct(), "node-fingerprints")
    first = materialize(prints.groupBy("fp").agg(F.min("node").alias("id")), "distinct-fingerprints")
    alike = prints.join(first, "fp").select(F.col("node").alias("a"), F.col("id").alias("b"))
    return alike.unionByName(simhash_dedup.links(first)).where("a <> b")


def _links(rows: DataFrame, node: str, keys: str, fp: str) -> DataFrame:
    """(a, b) nodes of similar sets, enough of them to connect all that are similar."""
    spark = rows.sparkSession
    nodes = materialize(rows.select(F.col(node).alias("node"), F.col(keys).alias("keys")).distinct(), "shingle-bands")
    postings = nodes.select("node", F.explode("keys").alias("key"))
    shared = materialize(postings.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last")).where(
        "first < last").drop("last"), "shared-bands")
    candidates = postings.join(shared, "key").where("node > first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    candidates = candidates.unionByName(_fingerprint_links(rows, node, keys, fp))
    found = components(materialize(candidates.distinct(), "band-links"))
    members = materialize(found.select("node", F.col("component").alias("grp")).unionByName(
        found.select(F.col("component").alias("node"), F.col("component").alias("grp")).distinct()), "candidates")
    texts = rows.select(F.col(node).alias("node"), "text").join(members, "node").groupBy("node", "grp").agg(F.min("text").alias("text"))
    sets = materialize(texts.mapInArrow(_sets, "node long, grp long, grams binary"), "shingle-sets")
    long = members.groupBy("grp").count().where(F.col("count") > BLOCK).select(
        "grp", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    cut = sets.join(materialize(long, "long-groups"), "grp", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    cut = cut.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where("blocks = 1 OR block <> other")
    cut = cut.select("grp", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "node", "grams")
    cut = cut.repartition(partitions(spark), "grp", "lo", "hi").sortWithinPartitions("grp", "lo", "hi", "node")
    return cut.mapInArrow(_compare, "a long, b long")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component of similar texts: that of the smallest doc_id, null before all others, and of
    these the one with the smallest text. A row goes only for a near copy; texts without words are copies of each other."""
    node, keys, fp = fresh(docs, "_node"), fresh(docs, "_bands"), fresh(docs, "_fp")
    rows = materialize(_with_nodes(docs, node, keys, fp), "shingle-nodes")
    found = components(materialize(_links(rows, node, keys, fp), "shingle-links")).select(F.col("node").alias(node), F.col("component").alias(keys))
    named = rows.drop(keys, fp).join(materialize(found, "shingle-components"), node, "left")
    order = ["doc_id", "text", *[c for c in docs.columns if c not in ("doc_id", "text")]]
    one = F.row_number().over(Window.partitionBy(F.coalesce(keys, node)).orderBy(*[F.col(f"`{c}`").asc_nulls_first() for c in order]))
    place = fresh(named, "_place")
    return named.withColumn(place, one).where(F.col(place) == 1).select(docs.columns)
