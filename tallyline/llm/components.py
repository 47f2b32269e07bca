"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import materialize


def _with_minimum(pairs: DataFrame) -> DataFrame:
    """Add ``m``, the smallest of u and all its v. The minima are a written table, so the
    join has a shuffle of its own on both sides and a node with very many links is split."""
    minima = materialize(pairs.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "minima")
    return pairs.join(minima, "u")


def components(links: DataFrame) -> DataFrame:
    """(a, b) long -> (node, component): the smallest id each linked node reaches.

    Self links and repeated links are harmless; ids without a link to another id are not in the result.
    Every step is a written table, so a lost executor repeats one step at most.
    """
    stars = materialize(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "stars")
    state = None
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_minimum(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _with_minimum(materialize(large, "large-star"))
        stars = materialize(
            small.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("p"))
            .select("p.u", "p.v").where("u <> v").distinct(), "stars")
        new = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == state:
            return stars.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = new
