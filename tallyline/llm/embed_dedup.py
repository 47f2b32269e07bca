"""Embedding near-dedup by cells of spherical k-means.

Centres are fitted on a bounded sample. Every vector has a home cell, the nearest centre, and looks into all cells
whose centre is less than MARGIN (of cosine) further than its nearest: that finds a close pair across a border if
either side looks into the other's home. In a cell, blocks of home vectors are multiplied with chunks of those that look
in, so that one very full cell becomes many tasks; a block hands on the number of links of each vector and a spanning
star of its links, never the pairs. Equal vectors are one row with a count. Measured recall of pairs at the threshold:
README; the tests measure it against all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import components_in_task, materialize, prepare, table
from tallyline.llm.components import components

MIN_COSINE, MARGIN = 0.9, 0.12
# The centres are fitted on so many vectors at most, and on so many bytes of them.
SAMPLE, SAMPLE_BYTES, MAX_CELLS, ROUNDS = 20_000, 64 << 20, 2048, 8
BLOCK, CHUNK = 512, 1024


def unit_rows(raw: list[bytes], kind: str) -> np.ndarray:
    """Vectors of length 1 in double precision; scaled first, so that no square overflows or vanishes."""
    v = np.frombuffer(b"".join(raw), dtype=kind).reshape(len(raw), -1).astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def fit_centres(sample: np.ndarray, cells: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means of unit rows, started from the first ones; a cell that gets empty keeps its centre."""
    centres = sample[:cells].copy()
    for _ in range(rounds):
        own = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 1e-12, sums / np.maximum(length, 1e-12), centres)
    return centres


def _packed(kind: str):
    """Bytes of the usable vectors; null for the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = []
            for x in b.column("embedding").to_pylist():
                v = np.array([np.nan if y is None else y for y in x or []], dtype=kind)
                raw.append(v.tobytes() if len(v) and np.isfinite(v).all() and v.any() else None)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(raw, pa.binary())], ["vec_id", "raw"])

    return run


def _cells(centres: dict[int, tuple[int, np.ndarray]], kind: str, margin: float):
    """Home cell, and all cells to look into, the home among them. ``centres`` has, for each size of a vector, its first cell
    and its centres; vectors of a size that the sample did not meet share a cell."""
    def looked(size: int, part: pa.RecordBatch) -> pa.RecordBatch:
        first, own = centres.get(size, (-size, np.zeros((1, 1))))
        unit = unit_rows(part.column("raw").to_pylist(), kind)
        near = unit @ own.T if size in centres else np.zeros((len(unit), 1))
        home = near.argmax(axis=1).astype(np.int32) + np.int32(first)
        row, cell = np.nonzero(near >= near.max(axis=1, keepdims=True) - margin)
        ends = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [part.column("id"), part.column("n"), part.column("raw"), pa.array(home), pa.ListArray.from_arrays(ends, (cell + first).astype(np.int32))],
            ["id", "n", "raw", "home", "cells"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = np.array([len(x) for x in b.column("raw").to_pylist()])
            for size in np.unique(sizes).tolist():
                yield looked(size, b.take(pa.array(np.flatnonzero(sizes == size))))

    return run


def _compare(kind: str, least: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        unit, cell = unit_rows(list(rows["raw"]), kind), int(rows["cell"].iloc[0])
        inside = np.flatnonzero(rows["inside"])
        outside = np.flatnonzero(~rows["inside"])
        home, n, ids, cells = (rows[c].to_numpy() for c in ("home", "n", "id", "cells"))
        a, b = np.nonzero(np.triu(unit[inside] @ unit[inside].T >= least, 1)) if rows["first"].iloc[0] else (np.zeros(0, int),) * 2
        x, y = np.nonzero(unit[outside] @ unit[inside].T >= least)
        a, b = np.concatenate([inside[a], outside[x]]), np.concatenate([inside[b], inside[y]])
        # Where each looks into the other's home, the pair counts in the cell with the smaller number only.
        twice = np.array([home[i] < cell and home[i] in cells[j] for i, j in zip(a, b, strict=True)], dtype=bool)
        a, b = a[~twice], b[~twice]
        links = np.zeros(len(rows), dtype=np.int64)
        np.add.at(links, a, n[b])
        np.add.at(links, b, n[a])
        label = components_in_task(len(rows), a, b)
        has = links > 0
        return pd.DataFrame({"id": ids[has], "links": links[has], "centre": ids[label][has]})

    return run


def link_vectors(vectors: DataFrame, least: float = MIN_COSINE, margin: float = MARGIN) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding).

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing; others link with vectors of
    their own length only, each length with centres of its own. Rows with a null vec_id link with nothing and have a
    null component. Repeated rows are vectors of their own that link with each other. An empty table stays empty.
    """
    spark = vectors.sparkSession
    prepare(spark)
    element = vectors.schema["embedding"].dataType.elementType.simpleString()
    kind = "<f4" if element == "float" else "<f8"
    rows = materialize(vectors.select("vec_id", "embedding").mapInArrow(_packed(kind), "vec_id long, raw binary"), "vectors")
    fits = F.col("vec_id").isNotNull() & F.col("raw").isNotNull()
    usable = rows.where(fits)
    distinct = materialize(usable.groupBy("raw").agg(F.min("vec_id").alias("id"), F.count("*").alias("n")), "distinct-vectors")
    count, longest = distinct.agg(F.count("*"), F.max(F.octet_length("raw"))).first()
    most = min(SAMPLE, max(1, SAMPLE_BYTES // (longest or 1)))
    sample: dict[int, list[bytes]] = {}
    for r in distinct.orderBy(F.xxhash64("id"), "id").limit(most).select("raw").collect():
        sample.setdefault(len(r["raw"]), []).append(bytes(r["raw"]))
    links = spark.createDataFrame([], "id long, links long, centre long")
    if sample:
        centres, first, sampled = {}, 0, sum(map(len, sample.values()))
        for size, vectors_ in sorted(sample.items()):
            cells = min(MAX_CELLS, len(vectors_), max(1, int((count * len(vectors_) / sampled)**0.5 / 2)))
            centres[size] = first, fit_centres(unit_rows(vectors_, kind), cells)
            first += cells
        held = materialize(distinct.mapInArrow(_cells(centres, kind, margin), "id long, n long, raw binary, home int, cells array<int>"), "vector-cells")
        looking = held.select(F.explode("cells").alias("cell"), (F.col("home") == F.col("cell")).cast("long").alias("own"))
        sizes = materialize(looking.groupBy("cell").agg(
            F.greatest(F.lit(1), F.ceil(F.sum("own") / BLOCK)).cast("int").alias("blocks"),
            F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks")), "cell-sizes")
        dealt = (
            held.withColumn("cell", F.explode("cells")).join(F.broadcast(sizes), "cell")  # a row for each cell: bounded by SAMPLE
            .withColumn("own", F.when(F.col("home") == F.col("cell"), F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")))
            .withColumn("chunk", F.pmod(F.xxhash64("id", F.lit(1)), F.col("chunks")).cast("int"))
        )
        inside = dealt.where("own IS NOT NULL").withColumn("block", F.col("own")).withColumn(
            "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumn("inside", F.lit(True))
        outside = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).where(
            "own IS NULL OR block > own").withColumn("inside", F.lit(False))
        both = inside.unionByName(outside).withColumn("first", F.col("chunk") == 0)
        links = both.select("cell", "block", "chunk", "first", "inside", "id", "n", "raw", "home", "cells").groupBy(
            "cell", "block", "chunk").applyInPandas(_compare(kind, least), "id long, links long, centre long")
    links = materialize(links, "vector-links")
    found = components(links.select(F.col("id").alias("a"), F.col("centre").alias("b")))
    totals = links.groupBy("id").agg(F.sum("links").alias("links"))
    named = distinct.join(totals, "id", "left").join(found, F.col("id") == F.col("node"), "left").select(
        "raw", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    named = materialize(named, "vector-components")
    linked = usable.join(named, "raw").select("vec_id", "n_links", "component_id")
    alone = rows.where(~fits).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"))
