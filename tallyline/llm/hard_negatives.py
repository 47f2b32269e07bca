"""Hard-negative mining by a vertical scan of the vectors' dimensions (BOND).

Rows are dealt into slices, anchors into groups; a task streams the rows of one slice past one group, in blocks that are
stored by dimension. For an anchor the dimensions are read in the order of its falling magnitudes, STEP at a time, and
what the unread ones can still add lies between sums of the block's smallest and largest contributions: a row stays a
candidate only while that range reaches what is looked for, and rows that are left at the end have exact scores. The
first scan looks for each anchor's most similar rows of its label, the second for the rows of other labels in the
score windows that these set. A task keeps the best few rows of each anchor and window, so the rows written grow with the
anchors; the number of slices depends on the number of rows alone.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.llm.common import materialize, partitions, prepare, table

POSITIVES, NEGATIVES = 5, 3
# A negative's score lies between these hundredths of its positive's.
LOW, HIGH = 50, 95
EVERY, SCALE = 50, 256
# Anchors of a task, rows of a slice (and slices at least), numbers of a block, dimensions of a step.
GROUP, SLICE, SLICES, BLOCK, STEP = 4096, 1 << 18, 16, 1 << 18, 8
_LONG = 2**63 - 1


def scaled(vector: list | None, scale: int) -> bytes | None:
    """floor(scale * x) of every component, as doubles; null for a vector that takes no part. Products beyond the largest double become it."""
    v = np.array([np.nan if y is None else y for y in vector or []], dtype=np.float64)
    if not len(v) or not np.isfinite(v).all():
        return None
    with np.errstate(over="ignore"):
        return np.clip(np.floor(scale * v), -np.finfo(float).max, np.finfo(float).max).tobytes()


def _integers(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [scaled(x, scale) for x in b.column("embedding").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), pa.array(raw, pa.binary())], ["vec_id", "label", "raw"])

    return run


class Block:
    """Rows by dimension, with the smallest and the largest value of each dimension."""

    def __init__(self, ids: list[int], labels: list[int], raw: list[bytes], kind=float):
        self.ids, self.labels = np.array(ids, dtype=np.int64), np.array(labels, dtype=np.int64)
        rows = np.frombuffer(b"".join(raw), dtype=np.float64).reshape(len(raw), -1)
        self.most = float(np.abs(rows).max())
        self.columns = np.ascontiguousarray(rows.T)
        if kind is object:
            self.columns = whole_numbers(self.columns)
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)


def whole_numbers(values: np.ndarray) -> np.ndarray:
    """Python integers, for scores that doubles cannot hold."""
    return np.array([int(x) for x in values.ravel()], dtype=object).reshape(values.shape)


def vertical_scan(query: np.ndarray, block: Block, rows: np.ndarray, wanted: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(places, exact scores) of those of ``rows`` that no bound excludes. ``wanted(least, most)`` says which rows
    with scores in these ranges may still be looked for."""
    order = np.argsort(-np.abs(query), kind="stable")
    small, large = query * block.low, query * block.high
    small, large = np.minimum(small, large)[order], np.maximum(small, large)[order]
    small, large = small[::-1].cumsum()[::-1], large[::-1].cumsum()[::-1]  # of the dimensions from a place on
    score = np.zeros(len(rows), dtype=block.columns.dtype)
    for at in range(0, len(order), STEP):
        dims = order[at:at + STEP]
        part = block.columns[dims]
        score = score + query[dims] @ (part if len(rows) == part.shape[1] else part[:, rows])
        if at + STEP < len(order):
            left = wanted(score + small[at + STEP], score + large[at + STEP])
            if not left.all():
                rows, score = rows[left], score[left]
                if not len(rows):
                    break
    return rows, score


class Best:
    """The best few (score, id) of a stream: higher scores first, of equal ones smaller ids."""

    def __init__(self, most: int):
        self.most, self.score, self.ids = most, [], []

    @property
    def least(self):
        """What a score has to reach to matter."""
        return self.score[-1] if len(self.score) == self.most else -math.inf

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        rows = sorted([*zip(self.score, self.ids, strict=True), *_top(score, ids, self.most)], key=lambda x: (-x[0], x[1]))[:self.most]
        self.score, self.ids = [r[0] for r in rows], [r[1] for r in rows]


def _top(score: np.ndarray, ids: np.ndarray, most: int) -> list[tuple]:
    if len(score) > most:
        edge = np.sort(score)[-most]
        score, ids = score[score >= edge], ids[score >= edge]
        order = np.lexsort((ids, -score.astype(np.float64))) if score.dtype != object else sorted(range(len(ids)), key=lambda i: (-score[i], ids[i]))
        score, ids = score[order[:most]], ids[order[:most]]
    return list(zip(score.tolist(), ids.tolist(), strict=True))


class SameLabel:
    """First scan: the most similar rows of an anchor's label; rows with its id are the anchor itself."""

    def __init__(self, most: int, _):
        self.best = Best(most)

    def scan(self, anchor_id: int, label: int, query: np.ndarray, block: Block) -> None:
        rows = np.flatnonzero((block.labels == label) & (block.ids != anchor_id))
        if len(rows):
            def wanted(least, most):
                bound = self.best.least
                if len(least) > self.best.most:
                    bound = max(bound, np.sort(least)[-self.best.most])
                return most >= bound

            rows, score = vertical_scan(query, block, rows, wanted)
            if len(rows):
                self.best.add(score, block.ids[rows])

    def found(self) -> Iterator[tuple[int, int, int]]:
        return ((0, i, s) for s, i in zip(self.best.score, self.best.ids, strict=True))


class OtherLabels:
    """Second scan: the most similar rows of other labels within the score window of each positive."""

    def __init__(self, most: int, positives: list[dict]):
        self.windows = [(p["place"], -(-p["score"] * LOW // 100), p["score"] * HIGH // 100, Best(most)) for p in positives]
        self.windows = [w for w in self.windows if w[1] <= w[2]]

    def scan(self, anchor_id: int, label: int, query: np.ndarray, block: Block) -> None:
        rows = np.flatnonzero((block.labels != label) & (block.ids != anchor_id))
        if len(rows) and self.windows:
            def wanted(least, most):
                left = np.zeros(len(least), dtype=bool)
                for _, low, high, best in self.windows:
                    left |= (most >= max(low, best.least)) & (least <= high)
                return left

            rows, score = vertical_scan(query, block, rows, wanted)
            for _, low, high, best in self.windows:
                inside = (score >= max(low, best.least)) & (score <= high)
                if inside.any():
                    best.add(score[inside], block.ids[rows[inside]])

    def found(self) -> Iterator[tuple[int, int, int]]:
        return ((place, i, s) for place, _, _, best in self.windows for s, i in zip(best.score, best.ids, strict=True))


def _scan(kind: type, most: int):
    """Stream of (dim, grp, slice), in each the anchors and then the rows: what ``kind`` finds for each anchor."""
    def searched(anchors: list[tuple], rows: list[tuple]) -> None:
        ids, labels, raw = zip(*rows, strict=True)
        block, big = Block(ids, labels, raw), None
        for key, anchor_id, label, query, search in anchors:
            if len(query) * np.abs(query).max() * block.most < 2**53:
                search.scan(anchor_id, label, query, block)
            else:
                big = big or Block(ids, labels, raw, object)
                search.scan(anchor_id, label, whole_numbers(query), big)

    def found(anchors: list[tuple]) -> pa.RecordBatch:
        out = [(a[0], a[1], *f) for a in anchors for f in a[4].found()]
        key, anchor, place, ids, score = zip(*out, strict=True) if out else [()] * 5
        score = [max(-_LONG - 1, min(_LONG, int(s))) for s in score]
        return pa.RecordBatch.from_arrays(
            [pa.array(key, pa.int64()), pa.array(anchor, pa.int64()), pa.array(place, pa.int32()), pa.array(ids, pa.int64()), pa.array(score, pa.int64())],
            ["anchor", "anchor_id", "place", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, anchors, rows = None, [], []
        for b in batches:
            for *at, anchor, vec_id, label, raw, positives in zip(
                    *[b.column(c).to_pylist() for c in ("dim", "grp", "slice", "anchor", "vec_id", "label", "raw", "positives")], strict=True):
                if at != current:
                    if anchors and rows:
                        searched(anchors, rows)
                    if anchors:
                        yield found(anchors)
                    current, anchors, rows = at, [], []
                if anchor is not None:
                    anchors.append((anchor, vec_id, label, np.frombuffer(raw, np.float64), kind(most, positives)))
                elif anchors:
                    rows.append((vec_id, label, raw))
                    if len(rows) * len(raw) >= 8 * BLOCK:
                        searched(anchors, rows)
                        rows = []
        if anchors and rows:
            searched(anchors, rows)
        if anchors:
            yield found(anchors)

    return run


def _scanned(rows: DataFrame, anchors: DataFrame, groups: int, slices: int, kind: type, most: int) -> DataFrame:
    """(anchor, anchor_id, place, vec_id, score): the best ``most`` rows for each anchor and place."""
    spark = rows.sparkSession
    columns = ["dim", "grp", "slice", "anchor", "vec_id", "label", "raw", "positives"]
    dealt = anchors.withColumn("grp", F.pmod("anchor", F.lit(groups)).cast("int")).withColumn(
        "slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))).select(columns)
    # Every row meets every group of anchors: the stated query set against all rows, in blocks.
    passed = rows.withColumn("slice", F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(slices)).cast("int")).withColumn(
        "grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumns(
        {"anchor": F.lit(None).cast("long"), "positives": F.lit(None).cast(anchors.schema["positives"].dataType)}).select(columns)
    stream = dealt.unionByName(passed).repartition(max(partitions(spark), slices), "dim", "grp", "slice").sortWithinPartitions(
        "dim", "grp", "slice", F.col("anchor").isNull(), "vec_id")
    found = stream.mapInArrow(_scan(kind, most), "anchor long, anchor_id long, place int, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("anchor", "anchor_id", "place").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= most)


def mine(vectors: DataFrame, every: int = EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, scale: int = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors of (vec_id, label,
    embedding), which are the rows whose vec_id is divisible by ``every``.

    Components become floor(``scale`` * x), scores are integer inner products, and ties go to the smaller vec_id. Rows with a
    null vec_id, label or vector, an empty vector, or a null or non-finite component take no part. Wholly equal rows count
    once; of rows that share a vec_id but differ each is an anchor, and none is a partner of another. Vectors of different
    lengths have no score. A score beyond a long becomes the nearest long. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    prepare(spark)
    made = vectors.select("vec_id", F.col("label").cast("long").alias("label"), "embedding").where("vec_id IS NOT NULL AND label IS NOT NULL")
    made = made.mapInArrow(_integers(scale), "vec_id long, label long, raw binary").where("raw IS NOT NULL").distinct()
    rows = materialize(made.withColumn("dim", F.octet_length("raw")), "whole-vectors")
    anchors = rows.where(F.col("vec_id") % every == 0).withColumn("anchor", F.xxhash64("vec_id", "label", "raw"))
    groups = max(1, -(-anchors.count() // GROUP))
    slices = max(SLICES, -(-rows.count() // SLICE))
    first = _scanned(rows, anchors.withColumn("positives", F.lit(None).cast("array<struct<place: int, vec_id: bigint, score: bigint>>")),
                     groups, slices, SameLabel, positives)
    first = materialize(first.select("anchor", "anchor_id", F.col("rank").alias("place"), "vec_id", "score"), "positives")
    known = first.groupBy("anchor", F.col("anchor_id").alias("vec_id")).agg(  # at most `positives` of an anchor
        F.sort_array(F.collect_list(F.struct("place", F.col("vec_id").alias("vec_id"), "score"))).alias("positives"))
    with_windows = materialize(anchors.join(known, ["anchor", "vec_id"]), "anchors")
    second = _scanned(rows, with_windows, groups, slices, OtherLabels, negatives)
    named = first.select("anchor", "anchor_id", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return second.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(
        named, ["anchor", "anchor_id", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings").select("vec_id", label.alias("label"), "embedding"))


SQL = f"""
WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS e FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.e, b.e)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % {EVERY} = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= {NEGATIVES}
"""
