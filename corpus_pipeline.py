"""The training-corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet in the shared folder and read
again as the next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import bpe, line_dedup, mixing, quality, shingle_dedup
from tallyline.llm.common import materialize, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality.judge(docs, table(spark, sf_dir, "labels")).where("kept").select(docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the lines that a document of a smaller id holds; ``n_chars`` follows the text."""
    out = line_dedup.drop_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (5-word shingles, similarity 0.8 or more) stays, that with the smallest id.
    Candidates come from the index of fingerprint bytes, and from bands beside it; an exact check follows."""
    return shingle_dedup.drop_near_copies(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it; those it does not take go."""
    return mixing.mix(docs).where("epochs > 0").withColumn(
        "epochs", F.explode(F.sequence(F.lit(1), F.col("epochs").cast("int")))).select(docs.columns)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes, a row for each row of the mix."""
    return bpe.digests(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("near-dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("byte-level bpe", bpe_stage),
]

# The quality rules hash words with XXH64, which the comparing SQL engine lacks; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
