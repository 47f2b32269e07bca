"""Grouping of spelling variants: words of a corpus that differ by one code point, the rarer led to the much more frequent.

Words are counted in the tasks that read the texts. Two words within one error share their first or their last half, and
so their first or last KEY code points: the vocabulary is dealt into shards twice, once by the beginning, once by the end
(words written backwards), and a word is looked up in its own shard of each. A shard is a bidirectional FM-index
(``fm_index``): one half is matched exactly, the other with one error. A beginning that holds more than SHARD words is cut
into pieces of that size, and its words are looked up in each piece. A word leaves a shard as one row: the number of its
near words there and the most frequent of them; pairs are never written.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import materialize, partitions, prepare, table
from tallyline.llm.fm_index import BidirectionalIndex

RUN = "[A-Za-zÀ-ÿ]+"
MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5
# Words of one index, and words looked up at once.
SHARD = 20_000
# Different words a task counts before it hands them on.
COUNTED = 200_000
# Every so many-th occurrence group of the query loses a letter.
TYPO = 199
_CODE = np.zeros(256, dtype=np.uint8)  # of Latin-1 characters: a to z, then from 0xC0 on
_CODE[97:123], _CODE[192:256] = np.arange(1, 27), np.arange(27, 91)
_ALPHABET = 91


def drop_letter(doc_id: int | None, run: bytes, text: str) -> str:
    """The query's planted typos: some words of some documents lose one code point."""
    h = zlib.crc32(run, zlib.crc32(b"null:" if doc_id is None else b"%d:" % doc_id))
    if h % TYPO:
        return text
    at = h % len(text)
    return text[:at] + text[at + 1:]


def word_counts(docs: DataFrame, edit: Callable[[int | None, bytes, str], str] | None = None, min_length: int = MIN_LENGTH) -> DataFrame:
    """(word, n) over all texts: maximal runs of letters of at least ``min_length`` code points, A-Z lower-cased.

    A null text has no words; whole texts are read, however long. ``edit`` may change a run of a document (it gets the id,
    the run's bytes and the run). Repeated rows count as often as they come; further columns are not read.
    """
    prepare(docs.sparkSession)
    find = re.compile(RUN).findall

    def sent(total: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                for word, n in Counter(find((text or "").encode().lower().decode())).items():
                    if len(word) >= min_length:
                        if edit:
                            word = edit(doc_id, word.encode(), word)
                            if len(word) < min_length:
                                continue
                        total[word] += n
                if len(total) >= COUNTED:
                    yield sent(total)
                    total.clear()
        yield sent(total)

    return docs.select("doc_id", "text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _flat(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    return _CODE[np.frombuffer("".join(words).encode("latin-1"), np.uint8)], np.cumsum(lengths) - lengths, lengths


class _Shard:
    """An index over sorted words, and the look-up of words in it."""

    def __init__(self, words: list[str], n: list[int], backwards: bool):
        self.words, self.n, self.backwards = words, np.array(n, dtype=np.int64), backwards
        codes, starts, lengths = _flat([w[::-1] for w in words] if backwards else words)
        self.index = BidirectionalIndex([codes[a:a + m] for a, m in zip(starts.tolist(), lengths.tolist(), strict=True)], _ALPHABET)

    def look_up(self, queries: list[str]) -> pa.RecordBatch:
        codes, starts, lengths = _flat([q[::-1] for q in queries] if self.backwards else queries)
        q, w = self.index.within_one_error(codes, starts, lengths, lengths - lengths // 2 if self.backwards else lengths // 2)
        if self.backwards:  # words that share the first half too are found from there
            other = np.array([self.words[j][:len(queries[i]) // 2] != queries[i][:len(queries[i]) // 2]
                              for i, j in zip(q.tolist(), w.tolist(), strict=True)], dtype=bool)
            q, w = q[other], w[other]
        order = np.lexsort((w, -self.n[w], q))  # words are sorted, so the smaller place is the smaller word
        q, w = q[order], w[order]
        first = np.flatnonzero(np.concatenate([[True], np.diff(q) != 0])) if len(q) else q
        count = np.diff(np.append(first, len(q)))
        return pa.RecordBatch.from_arrays(
            [pa.array([queries[i] for i in q[first].tolist()], pa.string()), pa.array(count, pa.int64()),
             pa.array(self.n[w[first]]), pa.array([self.words[j] for j in w[first].tolist()], pa.string())],
            ["word", "n_near", "best_n", "best"])


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From a stream sorted by shard, its indexed words first and in order."""
    key, shard, words, counts, queries = None, None, [], [], []

    def built() -> Iterator[pa.RecordBatch]:
        nonlocal shard
        if shard is None and words:
            shard = _Shard(words, counts, bool(key[0]))
            for at in range(0, len(words), SHARD):
                yield shard.look_up(words[at:at + SHARD])

    def asked() -> Iterator[pa.RecordBatch]:
        nonlocal queries
        if queries and shard:
            yield shard.look_up(queries)
        queries = []

    for b in batches:
        for *at, other, word, n in zip(*[b.column(c).to_pylist() for c in ("side", "cell", "piece", "other", "word", "n")], strict=True):
            if at != key:
                yield from built()
                yield from asked()
                key, shard, words, counts = at, None, [], []
            if other:
                yield from built()
                queries.append(word)
                if len(queries) >= SHARD:
                    yield from asked()
            else:
                words.append(word)
                counts.append(n)
    yield from built()
    yield from asked()


def near_words(vocabulary: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(word, n_near, best_n, best) of every word of (word, n), a written table, that has a near word: how many words differ
    from it by one inserted, deleted or replaced code point, and the most frequent of them (of several, the smallest)."""
    spark = vocabulary.sparkSession
    prepare(spark)
    width = min_length // 2
    cells = max(partitions(spark), -(-vocabulary.count() // (SHARD // 2)))
    sides = vocabulary.select("word", "n", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.substring("word", 1, width).alias("key")),
        F.struct(F.lit(1).alias("side"), F.right("word", F.lit(width)).alias("key")))).alias("s")).select("word", "n", "s.*")
    large = sides.groupBy("side", "key").count().where(F.col("count") > SHARD).select(
        "side", "key", F.ceil(F.col("count") / SHARD).cast("int").alias("pieces"))
    dealt = sides.join(materialize(large, "large-keys"), ["side", "key"], "left").withColumn(
        "cell", F.when(F.col("pieces").isNull(), F.pmod(F.xxhash64("key"), F.lit(cells))).otherwise(F.xxhash64("key")))
    dealt = dealt.withColumn("piece", F.explode(F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1))).withColumn(
        "other", F.coalesce(F.pmod(F.xxhash64("word", F.lit(1)), F.col("pieces")) != F.col("piece"), F.lit(False)))
    sorted_ = dealt.select("side", "cell", "piece", "other", "word", "n").repartition(
        partitions(spark), "side", "cell", "piece").sortWithinPartitions("side", "cell", "piece", "other", "word")
    found = sorted_.mapInArrow(_look_up, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("least"), F.col("best").alias("best")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.least")).alias("best_n"), F.col("b.best").alias("best"))


def with_roots(forms: DataFrame) -> DataFrame:
    """Add ``root``, the last word reached from ``word`` by ``form``; forms have no cycles, as each is more frequent."""
    state = materialize(forms.select("word", F.coalesce("form", "word").alias("root"), F.col("form").isNotNull().alias("moved")), "roots")
    while state.where("moved").head(1):
        ahead = state.where("word <> root").select(F.col("word").alias("via"), F.col("root").alias("further"))
        state = materialize(state.join(ahead, F.col("root") == F.col("via"), "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
    return forms.join(state.select("word", "root"), "word")


def group_variants(counts: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of (word, n) with ``min_count`` occurrences and ``min_length``
    code points or more.

    ``form`` is the most frequent near word if it comes at least ``ratio`` times as often, ``root`` the end of the chain of
    forms; of equally frequent ones the smallest by code point counts. A null word is no word. An empty table stays empty.
    """
    words = materialize(counts.where((F.col("n") >= min_count) & (F.length("word") >= min_length)).select("word", "n"), "vocabulary")
    near = materialize(near_words(words, min_length), "near-words")
    strong = F.col("best_n") >= ratio * F.col("n")
    forms = words.join(near, "word", "left").select(
        "word", F.when(strong, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("best_n")).alias("form_n"))
    return with_roots(materialize(forms, "forms")).select("word", "form", "root", "n", "n_near", "form_n")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(word_counts(table(spark, sf_dir, "documents"), drop_letter))


# CRC32 as a fold over the bytes of a text (its hexadecimal digits taken in pairs), with the table of its steps.
SQL = rf"""
WITH RECURSIVE t AS (SELECT list(c ORDER BY i) AS steps FROM (SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c FROM range(256) r(i))),
o AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[a-z\x{{00C0}}-\x{{00FF}}]+')) AS run FROM documents),
g AS (SELECT doc_id, run, count(*) AS n FROM o WHERE length(run) >= {MIN_LENGTH} GROUP BY ALL),
x AS (SELECT *, hex(encode(coalesce(doc_id::VARCHAR, 'null') || ':' || run)) AS digits FROM g),
c AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(len(digits) // 2),
    lambda i: ('0x' || substr(digits, 2 * i + 1, 2))::BIGINT)),
    lambda a, b: xor(steps[(xor(a, b) & 255) + 1], a >> 8))) AS h FROM x, t),
v AS (SELECT CASE WHEN h % {TYPO} = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
    sum(n)::BIGINT AS n FROM c GROUP BY 1 HAVING sum(n) >= {MIN_COUNT} AND length(word) >= {MIN_LENGTH}),
d AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS cut FROM (SELECT *, unnest(range(length(word))) AS i FROM v)),
p AS (SELECT a.word, b.word AS near, b.n AS m FROM d a JOIN d b ON a.i = b.i AND a.cut = b.cut AND a.word <> b.word
    UNION SELECT d.word, v.word, v.n FROM d JOIN v ON d.cut = v.word UNION SELECT v.word, d.word, d.n FROM d JOIN v ON d.cut = v.word),
b AS (SELECT word, count(*) AS n_near, max(m) AS best_n FROM p GROUP BY word),
f AS (SELECT v.word, v.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.best_n >= {RATIO} * v.n THEN b.best_n END AS form_n FROM v LEFT JOIN b USING (word)),
w AS (SELECT f.*, (SELECT min(near) FROM p WHERE p.word = f.word AND p.m = f.form_n) AS form FROM f),
r AS (SELECT word, word AS root FROM w WHERE form IS NULL UNION ALL SELECT w.word, r.root FROM w JOIN r ON w.form = r.word)
SELECT word, form, root, n, n_near, form_n FROM w JOIN r USING (word)
"""
