"""Byte-level BPE encoding by overlapping chunks, and decoding.

Long texts are cut into overlapping chunks that are pre-tokenised in parallel. Neighbours are stitched at the first
boundary of pre-tokens that both found in their overlap: from there on they agree. The pieces between stitches are
encoded in parallel, and their ids are put together in order. Short texts are one chunk and need no stitching.
Decoding joins the raw bytes of the ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import partitions, prepare, table
from tallyline.llm.pieces import rank_file_cache, ranks

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
CHUNK, OVERLAP = 32_768, 1_024
# A pre-token that ends this near to the end of a chunk may go on behind it.
MARGIN = 4


def boundaries(text: str, pattern: str) -> list[int]:
    """Ends of pre-tokens behind a character that is no white space. A text cut there splits like the whole: only runs
    of white space look at what follows them."""
    import regex

    return [m.end() for m in regex.finditer(pattern, text) if not text[m.end() - 1].isspace()]


def stitches(heads: list[np.ndarray], tails: list[np.ndarray]) -> list[int]:
    """Cut places of a text: the first boundary that chunk i and chunk i + 1 share. Where two share none, the chunks
    behind are not known to agree with the whole text, and it is left uncut from there on."""
    cuts = []
    for tail, head in zip(tails[:-1], heads[1:], strict=True):
        common = np.intersect1d(tail, head)
        if not len(common):
            break
        cuts.append(int(common[0]))
    return cuts


def _list_array(packed: list[bytes]) -> pa.Array:
    ends = np.cumsum([0, *[len(x) // 4 for x in packed]], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), dtype="<i4")))


def _encoder(vocabulary: str, pattern: str, keys: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = rank_file_cache(vocabulary, pattern)
        for b in batches:
            ids = [cache.ids(t or "") for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in keys], _list_array(ids)], [*keys, "ids"])

    return run


def _marks(pattern: str, chunk: int, overlap: int):
    """Boundaries of each chunk inside its two overlaps, as places in the whole text."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [np.array(boundaries(t, pattern), dtype=np.int64) for t in b["text"]]
            at = b["n"] * chunk
            b["head"] = [(x[x <= overlap - MARGIN] + a).tolist() for x, a in zip(found, at, strict=True)]
            b["tail"] = [(x[(x >= chunk) & (x <= chunk + overlap - MARGIN)] + a).tolist() for x, a in zip(found, at, strict=True)]
            yield b

    return run


def _cut(chunk: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("n")
        whole = "".join(t[:chunk] for t in rows["text"][:-1]) + rows["text"].iloc[-1]
        cuts = [0, *stitches(list(rows["head"]), list(rows["tail"])), len(whole)]
        return pd.DataFrame({"doc_id": rows["doc_id"].iloc[0], "digest": rows["digest"].iloc[0], "times": rows["times"].iloc[0],
                             "n": range(len(cuts) - 1), "text": [whole[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]},
                            ).astype({"doc_id": "Int64"})

    return run


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = public_tokenizers.PATTERN,
           chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, ids array<int>) of every row's whole text; no special tokens.

    A null or empty text has no ids. Rows are independent: repeated rows give repeated results, and a null doc_id stays
    null. Further columns are not looked at. ``vocabulary`` is a rank file that every executor has.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = docs.select("doc_id", "text")
    is_long = F.coalesce(F.length("text") > chunk + overlap, F.lit(False))
    short = rows.where(~is_long).mapInArrow(_encoder(vocabulary, pattern, ["doc_id"]), "doc_id long, ids array<int>")
    # Equal rows are one long text, counted.
    long = rows.where(is_long).groupBy("doc_id", "text").agg(F.count("*").alias("times"))
    n = F.floor((F.length("text") - overlap - 1) / chunk).cast("int")
    chunks = long.select("doc_id", F.sha2("text", 256).alias("digest"), "times", "text", F.explode(F.sequence(F.lit(0), n)).alias("n")).select(
        "doc_id", "digest", "times", "n", F.expr(f"substring(text, n * {chunk} + 1, {chunk + overlap})").alias("text"))
    keys = "doc_id long, digest string, times long, n int, text string"
    marked = chunks.repartition(partitions(spark), "digest", "n").mapInPandas(
        _marks(pattern, chunk, overlap), f"{keys}, head array<long>, tail array<long>")
    pieces = marked.groupBy("doc_id", "digest").applyInPandas(_cut(chunk), keys)
    encoded = pieces.repartition(partitions(spark), "digest", "n").mapInArrow(
        _encoder(vocabulary, pattern, ["doc_id", "digest", "times", "n"]), "doc_id long, digest string, times long, n int, ids array<int>")
    joined = encoded.groupBy("doc_id", "digest").agg(
        F.first("times").alias("times"), F.array_sort(F.collect_list(F.struct("n", "ids"))).alias("parts"))
    joined = joined.select("doc_id", F.flatten("parts.ids").alias("ids"), F.explode(F.sequence(F.lit(1), F.col("times")))).drop("col")
    return short.unionByName(joined)


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``encoded`` (doc_id, ids) with ``decoded``: the raw bytes of the ids. They are bytes, not text: ids need not end
    at characters. An id that the vocabulary lacks fails the job; null ids give null."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_id = {i: b for b, i in ranks(vocabulary).items()}
        for b in batches:
            ids = b.column("ids")
            texts = [None if x is None else b"".join(map(by_id.__getitem__, x)) for x in ids.to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), ids, pa.array(texts, pa.binary())], ["doc_id", "ids", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, decoded binary")


def digests(docs: DataFrame) -> DataFrame:
    """Encode, decode, and digest both."""
    out = decode(encode(docs))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
