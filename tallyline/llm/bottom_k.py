"""Document fingerprints: bottom-k sketches of word shingles, as expressions of built-in functions.

The sketch of a text is the sorted array of the K smallest distinct 64-bit hashes of its shingles (SHINGLE words; all words
together if there are fewer; none without words). The sketch of several texts or parts together is the K smallest of
their sketches' hashes. Two sketches estimate resemblance (the share of the union's K smallest that both have), containment and
the number of distinct shingles; all are exact while the union has K shingles at most.

The query compares neighbours in the order of doc_id. Positions come from a table without texts; then each document sends
the beginning that its neighbour wants, and its own sketch, to the neighbour's key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.llm.common import materialize, table
from tallyline.llm.quality import bind, word_array
from tallyline.operators.ordering import with_position

K, SHINGLE = 128, 5


def shingle_hashes(text: str | F.Column, shingle: int = SHINGLE) -> F.Column:
    """Hashes of all shingles of a text, repeats included; a null text has none."""
    def windows(w):
        n = F.size(w)
        many = F.transform(F.sequence(F.lit(1), n - (shingle - 1)), lambda i: F.xxhash64(*[F.element_at(w, i + j) for j in range(shingle)]))
        none = F.array().cast("array<bigint>")
        return F.when(n >= shingle, many).when(n > 0, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(none)

    return bind(word_array(text), windows)


def sketch(text: str | F.Column, k: int = K, shingle: int = SHINGLE) -> F.Column:
    return F.slice(F.sort_array(F.array_distinct(shingle_hashes(text, shingle))), 1, k)


def merged(a: F.Column, b: F.Column, k: int = K) -> F.Column:
    """Sketch of two sketched texts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_sketches(sketches: DataFrame, keys: list[str], column: str = "sketch", k: int = K) -> DataFrame:
    """(keys, sketch): one sketch for all rows of each key; rows of null or empty sketches add nothing, and keys with no other rows
    are not in the result. Hashes are cut to the smallest ``k`` of a key in every task first, so no key is gathered whole."""
    hashes = sketches.select(*keys, F.explode(column).alias("_hash")).distinct()
    first = F.row_number().over(Window.partitionBy(*keys).orderBy("_hash"))
    return hashes.withColumn("_place", first).where(F.col("_place") <= k).groupBy(*keys).agg(
        F.sort_array(F.collect_list("_hash")).alias("sketch"))


def resemblance(a: F.Column, b: F.Column, k: int = K) -> F.Column:
    """Estimated Jaccard similarity of the shingle sets; of two empty ones 1."""
    union = merged(a, b, k)
    both = F.size(F.array_intersect(union, F.array_intersect(a, b))).cast("double")
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct_count(a: F.Column, k: int = K) -> F.Column:
    """Estimated number of distinct shingles: exact below ``k``, else from the share of hash values up to the k-th."""
    share = (F.element_at(a, k).cast("double") + float(2**63)) / float(2**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / share)


def containment(a: F.Column, b: F.Column, k: int = K) -> F.Column:
    """Estimated share of a's shingles that b has; 1 if a has none."""
    shared = resemblance(a, b, k) * distinct_count(merged(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / distinct_count(a, k)))


def as_text(a: F.Column) -> F.Column:
    """16 hexadecimal digits for each hash."""
    return F.array_join(F.transform(a, lambda x: F.lpad(F.hex(x), 16, "0")), "")


def _key(doc_id: str, prefix: str = "") -> dict[str, F.Column]:
    """Equal for equal ids, a null one among them, and never null."""
    return {f"{prefix}id": F.coalesce(doc_id, F.lit(0)), f"{prefix}none": F.col(doc_id).isNull()}


def compare_neighbours(docs: DataFrame, k: int = K, part: int = 4) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, sketch, edited_sketch, near_edited, near_next) for every row of (doc_id, text).

    The edited text has its last floor(n_chars / ``part``) code points replaced by the first as many (or all) of the next
    document; after the last comes the first, and a single document is its own neighbour. Documents are in ascending order of
    doc_id, null first, those of one id in the order of a hash of their texts. Rows equal in both are one document here, and get
    equal results. A null text is empty. Texts are read whole, however long; further columns are not looked at.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumns(
        {**_key("doc_id"), "hash": F.xxhash64("text")}).select("id", "none", "hash", "text")
    order = rows.select("id", "none", "hash", F.char_length("text").alias("n")).distinct()
    placed = materialize(with_position(order, [F.desc("none"), "id", "hash"]), "places")
    count = placed.count()
    owners = placed.select(
        F.pmod(F.col("position") + 1, F.lit(max(1, count))).alias("position"), F.col("id").alias("owner_id"), F.col("none").alias("owner_none"),
        F.col("hash").alias("owner_hash"), F.floor(F.col("n") / part).cast("int").alias("wanted"))
    wanted = materialize(placed.join(owners, "position").drop("position", "n"), "neighbours")
    sent = rows.join(wanted, ["id", "none", "hash"]).groupBy("owner_id", "owner_none", "owner_hash").agg(
        F.first(F.struct(F.expr("left(text, wanted)").alias("beginning"), sketch("text", k).alias("sketch"))).alias("next"))
    sent = sent.select(F.col("owner_id").alias("id"), F.col("owner_none").alias("none"), F.col("owner_hash").alias("hash"), "next")
    n = F.char_length("text")
    edited = F.concat(F.expr(f"left(text, char_length(text) - cast(floor(char_length(text) / {part}) AS int))"), F.col("next.beginning"))
    whole = rows.join(sent, ["id", "none", "hash"]).select(
        F.when(~F.col("none"), F.col("id")).alias("doc_id"), n.cast("long").alias("n_chars"), edited.alias("edited"),
        sketch("text", k).alias("sketch"), F.col("next.sketch").alias("next_sketch"))
    both = whole.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "sketch", sketch("edited", k).alias("edited_sketch"), "next_sketch")
    return both.select(
        "doc_id", "n_chars", "edited_sha256", "sketch", "edited_sketch", resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_neighbours(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        "near_edited", "near_next")
