"""Mixing sources to target weights by weighted sampling without replacement.

Every document draws the exponential key -ln(u) / w (Efraimidis and Spirakis), u from its id and its text and w its
quality weight. A source that needs t times its size is taken floor(t) times whole (complete epochs); for the rest its
documents, in the order of their keys, are taken until the remaining words are used up. The prefix sums need no
task that holds a whole source: keys are cut into ranges by approximate quantiles, each range is summed, and only
inside a range are rows sorted. All that leaves this step is one cut-off per source, so texts are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.llm.common import WORD, fresh, hash01, materialize, partitions, table

MAX_EPOCHS = 3
SEED = "mix-1"
# Characters whose share lowers the quality weight.
MARKS = "[#*$%&|<>]"


def words(text: str) -> F.Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: str) -> F.Column:
    """1 for plain prose, falling with the share of marks, 0.1 at least."""
    marks = F.regexp_count(F.col(text), F.lit(MARKS)).cast("double")
    share = marks / F.greatest(F.length(text), F.lit(1)).cast("double")
    return F.coalesce(F.greatest(F.lit(0.1), 1.0 - 10.0 * share), F.lit(0.1))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0) -> DataFrame:
    """(source, source_size) -> the same with ``target``: ``share`` of all words dealt by weight, no source above
    MAX_EPOCHS times its size. Sources by code point, null last, take the weights in turn. Capped sources are those
    with the smallest size for their weight, so one sort finds the level that all others share."""
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), F.encode("source", "UTF-8"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    pick = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    dealt = (
        sizes.withColumn("w", pick.cast("long")).withColumn("cap", F.col("source_size") * MAX_EPOCHS)
        .withColumn("left", F.sum("source_size").over(whole) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("left_w", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0)))
        .withColumn("level", F.col("left").cast("double") / F.col("left_w"))
        .withColumn("capped", F.col("level") * F.col("w") > F.col("cap"))
        .withColumn("rank", F.row_number().over(by_ratio))
        .withColumn("shared", F.min(F.when(~F.col("capped"), F.struct("rank", "level"))).over(whole)["level"])
    )
    return dealt.select(
        "source", "source_size",
        F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
            F.least(F.col("shared") * F.col("w"), F.col("cap").cast("double"))).alias("target"))


def draw(seed: str) -> F.Column:
    """The key of a row of (doc_id, text)."""
    return -F.log(hash01("doc_id", F.md5(F.coalesce("text", F.lit(""))), F.lit(seed))) / quality_weight("text")


def _cut_offs(rows: DataFrame, targets: DataFrame, pieces: int) -> DataFrame:
    """Per source the last (key, id) of its fractional epoch, null if none is taken."""
    wanted = targets.select(
        F.col("source").alias("s"), "source_size", "target",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).alias("epochs"),
    ).withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    steps = F.array(*[F.lit((i + 1) / pieces) for i in range(pieces - 1)])
    cuts = rows.groupBy("source").agg(F.percentile_approx("key", steps, F.lit(pieces * 4)).alias("cuts"))
    cuts = cuts.select(F.col("source").alias("c"), "cuts")
    ranged = rows.join(cuts, F.col("source").eqNullSafe(F.col("c"))).withColumn(
        "piece", F.size(F.filter("cuts", lambda x: x < F.col("key")))).drop("c", "cuts")
    sums = ranged.groupBy("source", "piece").agg(F.sum("size").alias("piece_size")).withColumn(
        "offset", F.coalesce(F.sum("piece_size").over(
            Window.partitionBy("source").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # The only range that has to be sorted is the one in which the rest runs out.
    edge = sums.join(wanted, F.col("source").eqNullSafe(F.col("s"))).where(
        (F.col("offset") <= F.col("rest")) & (F.col("rest") <= F.col("offset") + F.col("piece_size")))
    edge = materialize(edge.select(F.col("source").alias("s"), F.col("piece").alias("p"), "offset", "rest"), "mix-edge")
    order = Window.partitionBy("source", "piece").orderBy("key", "doc_id")
    summed = (
        ranged.join(edge, F.col("source").eqNullSafe(F.col("s")) & (F.col("piece") == F.col("p")))
        .withColumn("cum", F.col("offset") + F.sum("size").over(order)))  # ties share one sum and go together
    inside = summed.groupBy("source", "piece", "key", "doc_id").agg(
        F.first("cum").alias("cum"), F.sum("size").alias("tied"), F.first("rest").alias("rest"), F.first("offset").alias("offset"))
    last = inside.where(F.col("cum") - F.col("tied") / 2 <= F.col("rest")).groupBy("source").agg(
        F.max(F.struct("key", "doc_id")).alias("last"))
    # All ranges that end before the rest does are taken whole: their largest key is a bound too.
    whole = sums.join(wanted, F.col("source").eqNullSafe(F.col("s"))).where(
        F.col("offset") + F.col("piece_size") <= F.col("rest")).select("source", "piece")
    whole = ranged.join(whole.withColumnRenamed("source", "s").withColumnRenamed("piece", "p"),
                        F.col("source").eqNullSafe(F.col("s")) & (F.col("piece") == F.col("p")))
    whole = whole.groupBy("source").agg(F.max(F.struct("key", "doc_id")).alias("last"))
    bound = last.unionByName(whole).groupBy("source").agg(F.max("last").alias("last")).withColumnRenamed("source", "b")
    return wanted.join(bound, F.col("s").eqNullSafe(F.col("b")), "left").select(
        "s", "source_size", "target", "epochs", F.col("last.key").alias("last_key"), F.col("last.doc_id").alias("last_id"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, seed: str = SEED) -> DataFrame:
    """Documents with ``size`` (words), ``source_size``, ``target``, ``epochs`` and ``taken`` (words, repeats counted).

    A null text has no words; a null source is a source of its own, sorted last; a null doc_id sorts first. Rows that share an
    id, or have none, draw keys of their own; rows equal in id and text draw equal keys and are taken together. Columns
    of the input that carry the name of a result column are replaced, all others stay. Texts are read whole, however
    long. An empty table gives an empty result; every row of the input is in the result once.
    """
    spark = docs.sparkSession
    base = docs.drop("size", "source_size", "target", "epochs", "taken")
    names = [fresh(base, f"_mix_{n}") for n in ("key", "source", "last_key", "last_id", "early")]
    key, source, last_key, last_id, early = names
    base = base.withColumn("size", words("text")).withColumn(key, draw(seed))
    rows = materialize(base.select("doc_id", "source", "size", F.col(key).alias("key")), "mix-rows")
    totals = materialize(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    targets = materialize(source_targets(totals, weights, share), "mix-targets")
    cut = materialize(_cut_offs(rows, targets, max(16, min(1000, partitions(spark)))), "mix-cuts")
    cut = cut.withColumnsRenamed({"s": source, "last_key": last_key, "last_id": last_id})
    out = base.join(cut, F.col("source").eqNullSafe(F.col(source)), "left")
    before = (F.col(key) < F.col(last_key)) | ((F.col(key) == F.col(last_key)) & (
        F.col("doc_id").isNull() | (F.col("doc_id") <= F.col(last_id))))
    out = out.withColumn(early, F.when(before, 1).otherwise(0)).withColumn("epochs", F.col("epochs") + F.col(early))
    return out.withColumn("taken", (F.col("size") * F.col("epochs")).cast("long")).drop(*names)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).select(
        "doc_id", "size", "source_size", "target", "taken")


SQL = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    (('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, '')) || ':{SEED}'), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u,
    coalesce(greatest(0.1, 1.0::DOUBLE - 10.0::DOUBLE * (len(regexp_extract_all(text, '{MARKS}'))::DOUBLE
        / greatest(length(text), 1)::DOUBLE)), 0.1::DOUBLE) AS q FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
    1 + (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 AS w FROM d GROUP BY source),
r AS (SELECT *, 3 * source_size AS cap, row_number() OVER (ORDER BY 3 * source_size / w, source IS NULL, encode(source)) AS rn,
    coalesce(sum(3 * source_size) OVER o, 0) AS caps, coalesce(sum(w) OVER o, 0) AS ws,
    sum(source_size) OVER () AS all_size, sum(w) OVER () AS all_w FROM s
    WINDOW o AS (ORDER BY 3 * source_size / w, source IS NULL, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (all_size - caps)::DOUBLE / (all_w - ws)::DOUBLE AS level FROM r),
t AS (SELECT source, source_size, CASE WHEN level * w > cap THEN cap::DOUBLE ELSE least(cap::DOUBLE, w * (
    SELECT arg_min(level, rn) FROM l WHERE NOT level * w > cap)) END AS target FROM l),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
p AS (SELECT doc_id, d.source, size, source_size, target, epochs, target - epochs * source_size AS rest,
    sum(size) OVER (PARTITION BY d.source ORDER BY -ln(u) / q, doc_id NULLS FIRST) AS cum
    FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, (size * (epochs + CASE WHEN cum - size / 2 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken
FROM p
"""
