"""Quality rules: a document's words are weighed by how much likelier a trusted sample writes them than the raw corpus.

Unigrams and bigrams are hashed into cells, whose number grows with the square root of the corpus (``cells_for``), as
the number of its frequent words does. Two multinomials, one over the trusted documents and one over
every document, give each cell the logarithm of its likelihood ratio; the trusted counts are smoothed towards the raw
corpus by SMOOTH counts a cell, so that a cell the sample hardly reaches says nothing. A document's score is the
sum over its n-grams, divided by their number (plus PRIOR, which draws very short texts towards 0); it is kept from
THRESHOLD on. The weights are one row with an array, which scoring reads as a scalar subquery: a projection of the scan, in
which no text is exploded or shuffled and no number passes through the driver's program. Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import SPACES, fresh, materialize, table

# Cells for n-grams of one kind: LEAST_CELLS, or CELLS times the square root of the number of words if that is more.
LEAST_CELLS, CELLS = 2**16, 16
# At most so many trusted documents are read for the target multinomial, those with the smallest id hashes.
TRUSTED = 20_000
PRIOR = 16
THRESHOLD = -0.1
SMOOTH = 10.0
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
RESULT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "llr", "base_failed", "kept"]


def word_array(text: str) -> F.Column:
    return F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+"), "")


def bind(value: F.Column, body) -> F.Column:
    """``body`` of a value that is computed once, however often the body names it and wherever the optimizer moves it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def cells_for(chars: int) -> int:
    """Cells for each kind of n-gram in a corpus of ``chars`` characters, six to a word: a power of two."""
    cells = LEAST_CELLS
    while cells < CELLS * (chars / 6) ** 0.5:
        cells *= 2
    return cells


def grams(words: F.Column, cells: int) -> F.Column:
    """Cells of the unigrams, then of the bigrams (``cells`` higher), of a bound word array."""
    n = F.size(words)
    one = F.transform(words, lambda x: F.pmod(F.xxhash64(x), F.lit(cells)).cast("int"))
    two = F.when(n > 1, F.transform(F.sequence(F.lit(1), n - 1), lambda i: (
        F.pmod(F.xxhash64(F.element_at(words, i), F.element_at(words, i + 1)), F.lit(cells)) + cells).cast("int")))
    return F.concat(one, F.coalesce(two, F.array().cast("array<int>")))


def trusted_ids(labels: DataFrame, most: int = TRUSTED) -> DataFrame:
    """Ids labelled good and not toxic by every label they have; at most ``most``, by hash."""
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("t"))
    good = good.where("q = 1 AND coalesce(t, 0) = 0 AND doc_id IS NOT NULL").select("doc_id")
    return good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def gram_weights(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, int]:
    """One row with the log-likelihood ratios of all cells, and the number of cells of a kind; the raw counts are over all
    documents. Without a trusted word all ratios are 0."""
    spark = docs.sparkSession
    cells = cells_for(docs.agg(F.sum(F.char_length("text"))).first()[0] or 0)
    trusted = materialize(trusted_ids(labels).select(F.col("doc_id").alias("trusted")), "trusted")
    counts = materialize(
        docs.select("doc_id", bind(word_array("text"), lambda w: grams(w, cells)).alias("cells"))
        .join(F.broadcast(trusted), F.col("doc_id") == F.col("trusted"), "left")  # at most TRUSTED ids
        .select(F.col("trusted").isNotNull().cast("long").alias("t"), F.explode("cells").alias("cell"))
        .groupBy("cell").agg(F.count("*").alias("raw"), F.sum("t").alias("target")), "gram-counts")
    kind = (F.col("cell") >= cells).alias("bigram")
    totals = counts.groupBy(kind).agg(F.sum("raw").alias("n_raw"), F.sum("target").alias("n_target"))
    ratio = F.log((F.col("target") + SMOOTH) / (F.col("raw") * (F.col("n_target") / F.col("n_raw")) + SMOOTH))
    counted = counts.withColumn("bigram", kind).join(F.broadcast(totals), "bigram")  # two rows
    counted = counted.select("cell", F.when(F.col("n_target") > 0, ratio).otherwise(0.0).alias("w"))
    every = spark.range(2 * cells).select(F.col("id").cast("int").alias("cell")).join(counted, "cell", "left")
    listed = F.sort_array(F.collect_list(F.struct("cell", F.coalesce("w", F.lit(0.0)).alias("w"))))
    return materialize(every.agg(F.transform(listed, lambda x: x["w"]).alias("weights")), "gram-weights"), cells


def _repeated_words(hashes: F.Column) -> F.Column:
    """Words in windows whose hash is found twice or more: sort the bound hashes, keep the places of equal neighbours,
    and add up how far each place reaches beyond the one before it."""
    def covered(s):
        def place(x, k):
            same = (F.get(s, k - 1)["h"] == x["h"]), (F.get(s, k + 1)["h"] == x["h"])
            return F.when(F.coalesce(same[0], F.lit(False)) | F.coalesce(same[1], F.lit(False)), x["i"]).otherwise(-1)

        places = F.array_sort(F.filter(F.transform(s, place), lambda p: p >= 0))
        return F.aggregate(
            places, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
            lambda a, p: F.struct((p + WINDOW).alias("end"), (a["n"] + p + WINDOW - F.greatest(p, a["end"])).alias("n")),
            lambda a: a["n"])

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(bind(pairs, covered))


def judgement(text: str, table_of: F.Column, cells: int, threshold: float) -> F.Column:
    """All of RESULT as one struct; ``table_of`` is a bound array of weights."""
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")

    def windows(w):
        n = F.size(w)
        found = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(
            *[F.element_at(w, i + k) for k in range(WINDOW)])))
        return F.coalesce(found, F.array().cast("array<bigint>"))

    def ratio(g):
        total = F.aggregate(g, F.lit(0.0), lambda a, c: a + F.element_at(table_of, c + 1))
        return total / (F.size(g) + PRIOR)

    def of_words(w):
        return F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                        bind(windows(w), _repeated_words).cast("long").alias("n_repeat_words"), bind(grams(w, cells), ratio).alias("llr"))

    def verdict(f):
        failed = (f["n_words"] < 10) | (100 * f["n_repeat_words"] > 20 * f["n_words"])
        return F.struct(
            f["n_words"].alias("n_words"), f["word_chars"].alias("word_chars"),
            F.coalesce(F.regexp_count(F.col(text), F.lit(SYMBOLS)), F.lit(0)).cast("long").alias("n_symbols"),
            bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            f["n_repeat_words"].alias("n_repeat_words"), f["llr"].alias("llr"), failed.alias("base_failed"),
            (~failed & (f["llr"] >= threshold)).alias("kept"))

    return bind(bind(word_array(text), of_words), verdict)


def score(docs: DataFrame, weights: DataFrame, cells: int, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the columns of RESULT; input columns of these names are replaced.

    A null or empty text has no words and fails the base rules, as does a text of fewer than 10 words or with over 20 %
    of its words in repeated windows. Every row is judged by itself, so ties and repeated rows are judged alike.
    """
    base = docs.drop(*RESULT)
    all_of = fresh(base, "_judgement")
    # Named once, so the optimizer puts the subquery in the place of the column; the array is never part of a row.
    held = fresh(base, "_weights")
    judged = bind(F.col(held), lambda table_of: judgement("text", table_of, cells, threshold))
    return base.withColumn(held, weights.select("weights").scalar()).withColumn(all_of, judged).select(
        *[F.col(f"`{c}`") for c in base.columns], f"{all_of}.*")


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Fit the weights on all of ``docs`` and a bounded sample of trusted ones, then score every document."""
    return score(docs, *gram_weights(docs, labels), threshold)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
