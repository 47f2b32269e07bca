"""Removal of long repeated byte strings with a logarithmic family of suffix arrays.

Suffixes are sampled: of the first SPREAD places of every string of LENGTH bytes, the one whose next 8 bytes hash
lowest is an anchor, so equal strings have their anchors at equal offsets, and a text has about 2 / SPREAD anchors for
each byte. A suffix array orders the suffixes at the anchors by the fingerprint of their first PREFIX bytes (suffixes
that share a long string share it and are neighbours). It is a bucketed, sorted table with one row for each stretch of
equal fingerprints: how many suffixes it has and the first of them. All places of suffixes are files beside it, as one
fingerprint may have a third of them.

Documents come in batches, whose number and size both grow with the square root of the input. A batch gets its array,
which is merge-scanned against the arrays of all levels: fingerprints found twice are long matches. Then it joins the
family; two levels of equal size merge into one of twice the size, and their files go. Bucketed alike, arrays are scanned
without a shuffle of the older ones. The places of the matches are read from the files of places. A family can be kept and opened
again, in another session too, to take in more batches.

Matches are resolved exactly: the bytes around an anchor that its strings cover are sent to the task of its
fingerprint (equal ones once for each sending task), and every string of LENGTH bytes that comes twice is a match there,
found by its hash and compared byte by byte. Fingerprints with more anchors than one task should take are resolved by
counting their strings one by one, each told by 128 bits.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import materialize, partitions, prepare, scratch_path, table
from tallyline.sinks.files import delete, read_text, replace_text

LENGTH, SPREAD = 200, 150
PREFIX = LENGTH - SPREAD
# Bytes of input whose square root counts as one batch; there are three batches at least.
BATCH_BYTES = 256 << 20
# Anchors of one fingerprint that one task resolves; more are resolved string by string.
GROUP = 30_000
# Bytes around anchors that a task gathers, to send equal ones once.
HELD = 24 << 20
_MASK = np.uint64(0xFFFFFFFF)
_RNG = np.random.default_rng(7)
_LETTER = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_SECOND = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, at least ``n`` of each."""
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]), 1 << 16)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers


def prefix_sums(text: np.ndarray, letter: np.ndarray = _LETTER) -> np.ndarray:
    """Running sums from which the hash of any piece follows; pieces here are far shorter than 1024 bytes, below which
    sums modulo 2^64 have no systematic collisions."""
    out = np.zeros(len(text) + 1, dtype=np.uint64)
    np.cumsum(letter[text] * _power(len(text))[0][:len(text)], out=out[1:])
    return out


def piece_hashes(sums: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    return (sums[starts + length] - sums[starts]) * _power(len(sums))[1][starts]


def anchors(raw: bytes, length: int = LENGTH, spread: int = SPREAD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first, last): the strings starting at first..last of a text have this anchor."""
    n = len(raw) - length + 1  # strings of the text
    if n <= 0:
        return (np.zeros(0, dtype=np.int64),) * 3
    m = n + spread - 1
    grams = np.ndarray((m,), dtype="<u8", buffer=raw, strides=(1,)).copy()
    mixed = grams * np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xCA9B0C7EBA1DA115)
    mixed = (mixed & ~_MASK) | np.arange(m, dtype=np.uint64)  # lowest hash, then leftmost
    rows = -(-m // spread)
    padded = np.full(rows * spread, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:m] = mixed
    square = padded.reshape(rows, spread)
    ahead = np.minimum.accumulate(square, axis=1).ravel()
    behind = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].ravel()
    low = (np.minimum(behind[:n], ahead[spread - 1:spread - 1 + n]) & _MASK).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(np.diff(low)) + 1])
    return low[first], first, np.concatenate([first[1:] - 1, [n - 1]])


def _entries(length: int, spread: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            places, keys, counts = [], [], []
            for t in b.column("text").to_pylist():
                raw = (t or "").encode()
                at = anchors(raw, length, spread)[0]
                counts.append(len(at))
                if len(at):
                    places.append(at)
                    keys.append(piece_hashes(prefix_sums(np.frombuffer(raw, np.uint8)), at, length - spread))
            row = np.repeat(np.arange(b.num_rows), counts)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c).take(pa.array(row)) for c in ("batch", "doc_id", "mark")],
                 pa.array(np.concatenate([np.zeros(0, np.int64), *places]).astype(np.int32)),
                 pa.array(np.concatenate([np.zeros(0, np.uint64), *keys]).view(np.int64))], ["batch", "doc_id", "mark", "place", "key"])

    return run


# Columns of the files of places.
PLACES = "key long, doc_id long, mark long, place int"
# Columns of a suffix array.
ARRAY = "key long, n long, first struct<doc_id: long, mark: long, place: int>"


def _merged(one: DataFrame, other: DataFrame) -> DataFrame:
    """Two arrays as one: a full join bucket by bucket (Spark 4.1 keeps both rows of a key when it groups a union of
    bucketed tables by their bucket column)."""
    other = other.select("key", F.col("n").alias("n2"), F.col("first").alias("first2"))
    n = F.coalesce("n", F.lit(0)) + F.coalesce("n2", F.lit(0))
    return one.join(other.hint("merge"), "key", "full").select("key", n.alias("n"), F.least("first", "first2").alias("first"))


class Family:
    """Levels of suffix arrays, bucketed by key and sorted, and the places of all suffixes. The files and, once it is kept,
    the list of them are in ``folder``."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark, self.buckets = spark, partitions(spark)
        self.folder = folder or scratch_path(spark, "suffix-arrays")
        self.levels: list[tuple[int, str]] = []  # batches in it, table
        self.stored: list[str] = []  # folders of places

    def _write(self, array: DataFrame) -> str:
        name = f"suffix_array_{uuid.uuid4().hex}"
        array.write.bucketBy(self.buckets, "key").sortBy("key").option("path", f"{self.folder}/{name}").saveAsTable(name)
        return name

    def _remove(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete(self.spark, f"{self.folder}/{name}")

    def _add(self, batch: DataFrame) -> DataFrame:
        first = F.min(F.struct("doc_id", "mark", "place"))
        new, size = self._write(batch.groupBy("key").agg(F.count("*").alias("n"), first.alias("first"))), 1
        array = self.spark.table(new)
        found = array.where("n > 1").select("key")
        for _, level in self.levels:
            found = found.unionByName(array.where("n = 1").join(self.spark.table(level), "key", "left_semi").select("key"))
        found = materialize(found, "long-matches")
        while self.levels and self.levels[-1][0] == size:
            old = self.levels.pop()[1]
            both = self._write(_merged(self.spark.table(new), self.spark.table(old)))
            self._remove(old)
            self._remove(new)
            new, size = both, 2 * size
        self.levels.append((size, new))
        return found

    def take(self, entries: DataFrame) -> DataFrame:
        """Take in the suffixes (batch, doc_id, mark, place, key) of some batches, one after the other; returns the keys now
        known to come twice, in a batch or in a batch and a level."""
        path, found = f"{self.folder}/places-{uuid.uuid4().hex}", self.spark.createDataFrame([], "key long")
        entries.write.partitionBy("batch").parquet(path)  # one scan of the texts for all batches
        self.stored.append(path)
        stored = self.spark.read.schema(entries.schema).parquet(path)
        for k in sorted(r["batch"] for r in stored.select("batch").distinct().collect()):
            found = found.unionByName(self._add(stored.where(F.col("batch") == k)))
        return found.distinct()

    def places(self, keys: DataFrame) -> DataFrame:
        """(key, doc_id, mark, place) of all suffixes of the given keys."""
        found = self.spark.createDataFrame([], PLACES)
        for path in self.stored:
            places = self.spark.read.schema(PLACES).parquet(path).select("key", "doc_id", "mark", "place")
            found = found.unionByName(places.join(keys, "key", "left_semi"))
        return found

    def keep(self) -> str:
        """Write the list of the levels, replacing the one before in one step; returns the folder to open."""
        kept = {"buckets": self.buckets, "levels": self.levels, "stored": self.stored}
        replace_text(self.spark, f"{self.folder}/levels.json", json.dumps(kept))
        return self.folder

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> Family:
        """A family that was kept, as it was then. It belongs to one writer; one that added to it has to keep it again."""
        family, kept = cls(spark, folder), json.loads(read_text(spark, f"{folder}/levels.json"))
        family.buckets, family.stored = kept["buckets"], kept["stored"]
        family.levels = [(n, name) for n, name in kept["levels"]]
        for _, name in family.levels:
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ARRAY}) USING parquet CLUSTERED BY (key) SORTED BY (key) "
                      f"INTO {family.buckets} BUCKETS LOCATION '{folder}/{name}'")
        return family

    def drop(self) -> None:
        """Remove the family with all its files."""
        for _, name in self.levels:
            self._remove(name)
        delete(self.spark, self.folder)
        self.levels, self.stored = [], []


def _contexts(length: int, spread: int, most: int = HELD):
    """The bytes that the strings of each candidate anchor cover; equal ones of a task once, with all their places. A
    task holds up to ``most`` bytes of them before it sends them on."""
    def sent(seen: dict[tuple[int, bytes], list[tuple]]) -> Iterator[pa.RecordBatch]:
        rows = pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in seen], pa.int64()), pa.array([c for _, c in seen], pa.binary()),
             *[pa.array([[m[i] for m in members] for members in seen.values()], pa.list_(pa.int64())) for i in range(3)]],
            ["key", "context", "docs", "marks", "starts"])
        for at in range(0, rows.num_rows, 10_000):
            yield rows.slice(at, 10_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, bytes], list[tuple]] = {}
        size = 0
        for b in batches:
            for doc, mark, text, places in zip(*[b.column(c).to_pylist() for c in ("doc_id", "mark", "text", "places")], strict=True):
                raw = text.encode()
                at, first, last = anchors(raw, length, spread)
                pick = np.isin(at, places)
                keys = piece_hashes(prefix_sums(np.frombuffer(raw, np.uint8)), at[pick], length - spread).view(np.int64)
                for key, lo, hi in zip(keys.tolist(), first[pick].tolist(), last[pick].tolist(), strict=True):
                    members = seen.setdefault((key, raw[lo:hi + length]), [])
                    size += 24 if members else hi - lo + length + 100
                    members.append((doc, mark, lo))
            if size > most:
                yield from sent(seen)
                seen, size = {}, 0
        yield from sent(seen)

    return run


def _windows(contexts: list[bytes], length: int, letter: np.ndarray = _LETTER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context number, place in it, hash) of all strings of ``length`` bytes in the contexts."""
    sizes = np.array([len(c) for c in contexts], dtype=np.int64)
    offsets = np.cumsum(sizes) - sizes
    n = sizes - length + 1
    row = np.repeat(np.arange(len(sizes)), n)
    place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    sums = prefix_sums(np.frombuffer(b"".join(contexts), np.uint8), letter)
    return row, place, piece_hashes(sums, offsets[row] + place, length)


def _numbers(contexts: list[bytes], row: np.ndarray, place: np.ndarray, hashed: np.ndarray, length: int) -> np.ndarray:
    """Equal numbers for equal strings only. Strings of one hash are compared with one of them, neighbours in a row at once;
    should two differ, all are told apart by their bytes."""
    _, which = np.unique(hashed, return_inverse=True)
    one = np.zeros(which.max(initial=-1) + 1, dtype=np.int64)
    one[which] = np.arange(len(which))
    other = one[which]
    at = np.flatnonzero(other != np.arange(len(which)))
    r, p, r2, p2 = row[at], place[at], row[other[at]], place[other[at]]
    if len(at):
        new = np.flatnonzero(np.concatenate([[True], (np.diff(r) != 0) | (np.diff(p) != 1) | (np.diff(r2) != 0) | (np.diff(p2) != 1)]))
        long = np.diff(np.concatenate([new, [len(at)]])) + length - 1
        for i, a, j, b, n in zip(*[x.tolist() for x in (r[new], p[new], r2[new], p2[new], long)], strict=True):
            if contexts[i][a:a + n] != contexts[j][b:b + n]:
                seen: dict[bytes, int] = {}
                return np.array([seen.setdefault(contexts[i][a:a + length], len(seen)) for i, a in zip(row.tolist(), place.tolist(), strict=True)])
    return which


def _runs(row: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive places: (row, first place, last place)."""
    if not len(row):
        return row, place, place
    new = np.flatnonzero(np.concatenate([[True], (np.diff(row) != 0) | (np.diff(place) != 1)]))
    end = np.concatenate([new[1:] - 1, [len(row) - 1]])
    return row[new], place[new], place[end]


def _resolve(length: int):
    """Spans of the strings that come twice, from a stream of contexts sorted by key."""
    def spans(keys: list, contexts: list, docs: list, marks: list, starts: list) -> pa.RecordBatch:
        out: list[tuple] = []
        if contexts:
            row, place, hashed = _windows(contexts, length)
            times = np.array([len(d) for d in docs], dtype=np.int64)
            which = _numbers(contexts, row, place, hashed, length)
            twice = np.bincount(which, weights=times[row]) > 1.5
            hit = twice[which]
            for r, a, z in zip(*[x.tolist() for x in _runs(row[hit], place[hit])], strict=True):
                out += [(d, m, s + a, s + z + length) for d, m, s in zip(docs[r], marks[r], starts[r], strict=True)]
        columns = list(zip(*out, strict=True)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "mark", "from", "to"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], [], [], []]
        for b in batches:
            for i, c in enumerate(("key", "context", "docs", "marks", "starts")):
                held[i] += b.column(c).to_pylist()
            if len(held[0]) < 10_000:
                continue
            end = len(held[0])  # the last key may go on
            while end and held[0][end - 1] == held[0][-1]:
                end -= 1
            if end:
                yield spans(*[h[:end] for h in held])
                held = [h[end:] for h in held]
        yield spans(*held)

    return run


def _strings(length: int):
    """One row for each string of a context and place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            contexts = b.column("context").to_pylist()
            row, place, hashed = _windows(contexts, length)
            second = _windows(contexts, length, _SECOND)[2]
            docs, marks, starts = (b.column(c).to_pylist() for c in ("docs", "marks", "starts"))
            times = np.array([len(d) for d in docs], dtype=np.int64)[row]
            pick = np.repeat(np.arange(len(row)), times)
            flat = [[x for r in row.tolist() for x in column[r]] for column in (docs, marks, starts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashed[pick].view(np.int64)), pa.array(second[pick].view(np.int64)), pa.array(flat[0], pa.int64()), pa.array(flat[1], pa.int64()),
                 pa.array(np.array(flat[2], dtype=np.int64) + place[pick])], ["string", "second", "doc_id", "mark", "from"])

    return run


def batches_of(docs: DataFrame) -> int:
    """How many batches a table of documents comes in."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    return max(3, math.ceil(math.sqrt(size / BATCH_BYTES)))


def suffixes(docs: DataFrame, batches: int = 1, length: int = LENGTH, spread: int = SPREAD) -> DataFrame:
    """(batch, doc_id, mark, place, key) of the suffixes at the anchors of the texts. Partitions of the input are dealt to the batches."""
    dealt = docs.select(F.pmod(F.spark_partition_id(), F.lit(batches)).alias("batch"), "doc_id", "mark", "text")
    return dealt.mapInArrow(_entries(length, spread), "batch int, doc_id long, mark long, place int, key long")


def repeated_spans(docs: DataFrame, length: int = LENGTH, spread: int = SPREAD, batches: int | None = None, group: int = GROUP) -> DataFrame:
    """(doc_id, mark, from, to) byte spans that strings coming twice cover; they may overlap. ``docs`` has doc_id, mark, text."""
    spark = docs.sparkSession
    long = docs.where(F.octet_length("text") >= length)
    family = Family(spark)
    hits = materialize(family.take(suffixes(long, batches or batches_of(long), length, spread)), "repeated-keys")
    wanted = materialize(family.places(hits).select("doc_id", "mark", "place", "key"), "candidates")
    family.drop()
    hot = materialize(wanted.groupBy("key").count().where(F.col("count") > group).select("key"), "hot-keys")
    by_doc = materialize(wanted.groupBy("doc_id", "mark").agg(F.collect_set("place").alias("places")), "candidate-places")
    chosen = long.join(by_doc.select(F.col("doc_id").alias("d"), F.col("mark").alias("m"), "places"),
                       F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m"))).select("doc_id", "mark", "text", "places")
    contexts = chosen.mapInArrow(
        _contexts(length, spread), "key long, context binary, docs array<long>, marks array<long>, starts array<long>")
    if hot.isEmpty():
        return contexts.repartition(partitions(spark), "key").sortWithinPartitions("key").mapInArrow(
            _resolve(length), "doc_id long, mark long, from long, to long")
    contexts = materialize(contexts, "contexts")
    cool = contexts.join(hot, "key", "left_anti").repartition(partitions(spark), "key").sortWithinPartitions("key").mapInArrow(
        _resolve(length), "doc_id long, mark long, from long, to long")
    strings = materialize(contexts.join(hot, "key", "left_semi").mapInArrow(
        _strings(length), "string long, second long, doc_id long, mark long, from long"), "hot-strings")
    twice = materialize(strings.groupBy("string", "second").count().where("count > 1").select("string", "second"), "hot-repeated")
    return cool.unionByName(strings.join(twice, ["string", "second"]).select("doc_id", "mark", "from", (F.col("from") + length).alias("to")))


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        size, gone, runs, kept = [], [], [], []
        for text, spans in zip(b.column("text").to_pylist(), b.column("spans").to_pylist(), strict=True):
            raw = (text or "").encode()
            parts, at, n, removed = [], 0, 0, 0
            for s in sorted(spans or [], key=lambda x: x["from"]):
                if s["from"] > at or n == 0:
                    parts.append(raw[at:s["from"]])
                    n += 1
                    removed += s["to"] - s["from"]
                    at = s["to"]
                elif s["to"] > at:
                    removed += s["to"] - at
                    at = s["to"]
            kept.append(b"".join([*parts, raw[at:]]))
            size.append(len(raw))
            gone.append(removed)
            runs.append(n)
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), *[pa.array(x, pa.int64()) for x in (size, gone, runs)], pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, length: int = LENGTH, spread: int = SPREAD, batches: int | None = None, group: int = GROUP) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary) for every row: the text without the bytes covered by a string of
    ``length`` bytes that also starts anywhere else. What is kept are bytes: a cut may fall inside a character.

    A null text is empty. Rows are told apart by doc_id and text, and rows equal in both are copies of each other. A null
    doc_id is an id like others. Further columns are not looked at; an empty table gives an empty result.
    """
    prepare(docs.sparkSession)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("mark", F.xxhash64("text"))
    spans = materialize(repeated_spans(rows, length, spread, batches, group), "repeated-spans")
    by_doc = spans.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("from", "to")).alias("spans"))
    by_doc = materialize(by_doc.select(F.col("doc_id").alias("d"), F.col("mark").alias("m"), "spans"), "spans-of-documents")
    joined = rows.join(by_doc, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m")), "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(
        _remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
