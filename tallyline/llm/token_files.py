"""Token-id files: independent zstandard frames, a seek table behind them, a checksum for each frame.

Layout of a file: frames of whole documents (little-endian unsigned 32-bit ids), a skippable frame with the document
index (ids and token counts), and a skippable frame in the format of the public zstandard seekable format: for each
frame its compressed size, its size and the lower half of the XXH64 of its content, then the number of frames, a
descriptor and the magic number. A reader fetches the end of the file, looks up the documents it wants and
decompresses their frames only. Plain zstandard tools can decompress the whole file.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.llm.common import full_address, materialize, partitions, prepare, scratch_path, shared_fs, table
from tallyline.llm.pieces import json_file_cache

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
END_ID = 0
FRAME_BYTES = 256 * 1024
# Fixed values of the seekable format.
SKIPPABLE, INDEX, SEEKABLE, WITH_CHECKSUMS = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1, 0x80


class FrameWriter:
    def __init__(self, out, level: int = 3, frame_bytes: int = FRAME_BYTES):
        self.out, self.frame_bytes, self.zstd = out, frame_bytes, zstandard.ZstdCompressor(level=level)
        self.pending: list[bytes] = []
        self.size = self.tokens = 0
        self.frames: list[tuple[int, int, int]] = []
        self.docs: list[tuple[int, int, int]] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id is not None, doc_id or 0, len(ids) // 4))
        self.pending.append(ids)
        self.size += len(ids)
        self.tokens += len(ids) // 4
        if self.size >= self.frame_bytes:
            self._flush()

    def _flush(self) -> None:
        raw = b"".join(self.pending)
        done = self.zstd.compress(raw)
        self.out.write(done)
        self.frames.append((len(done), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.pending, self.size = [], 0

    def close(self) -> None:
        if self.pending:
            self._flush()
        known, ids, counts = (np.array([d[i] for d in self.docs], dtype=t) for i, t in enumerate(("<u1", "<i8", "<u4")))
        index = struct.pack("<I", len(ids)) + known.tobytes() + ids.tobytes() + counts.tobytes()
        table = b"".join(struct.pack("<III", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), WITH_CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack("<II", INDEX, len(index)) + index)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)


class FrameReader:
    """Document index of an open file; ``read`` decompresses the frames of the wanted documents only."""

    def __init__(self, f, size: int):
        self.f = f
        self.frames_read = 0
        f.seek(size - 9)
        n, kind, magic = struct.unpack("<IBI", f.read(9))
        if magic != SEEKABLE or kind != WITH_CHECKSUMS:
            raise ValueError("not a token file")
        f.seek(size - 9 - 12 * n)
        self.frames = np.frombuffer(f.read(12 * n), dtype="<u4").reshape(n, 3).astype(np.int64)
        self.places = np.concatenate([[0], np.cumsum(self.frames[:, 0])])
        f.seek(int(self.places[-1]))
        index_magic, length = struct.unpack("<II", f.read(8))
        if index_magic != INDEX:
            raise ValueError("the document index is missing")
        index = f.read(length)
        (m,) = struct.unpack_from("<I", index)
        self.known = np.frombuffer(index, "<u1", m, 4).astype(bool)
        self.ids = np.frombuffer(index, "<i8", m, 4 + m)
        self.counts = np.frombuffer(index, "<u4", m, 4 + 9 * m).astype(np.int64)
        self.starts = np.cumsum(self.counts) - self.counts

    def read(self, wanted: np.ndarray | None = None) -> Iterator[tuple[int, bytes]]:
        """(place in the index, ids) of the wanted places, in order."""
        ends = np.cumsum(self.frames[:, 1]) // 4
        frame_of = np.searchsorted(ends, self.starts, side="right").clip(0, max(0, len(ends) - 1))
        wanted = np.arange(len(self.ids)) if wanted is None else wanted
        current, raw = -1, b""
        for i in wanted:
            if (k := int(frame_of[i])) != current:
                self.f.seek(int(self.places[k]))
                raw = zstandard.ZstdDecompressor().decompress(self.f.read(int(self.frames[k, 0])), max_output_size=int(self.frames[k, 1]))
                if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.frames[k, 2]:
                    raise ValueError(f"frame {k} is damaged")
                current, self.frames_read = k, self.frames_read + 1
            at = int(self.starts[i] - (ends[k] - self.frames[k, 1] // 4)) * 4
            yield int(i), raw[at:at + int(self.counts[i]) * 4]


def write_token_files(docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """Encode every text and write the files into ``folder`` (a new shared folder), in ascending doc_id order from file to
    file and within; returns the manifest (part, file, docs, tokens, start), ``start`` the ids in all files before.

    A null text is empty; every document ends with ``end_id``. A null doc_id sorts first; equal doc_ids are ordered by
    their texts, and repeated rows are written as often as they come. An empty table gives no files. A repeated task
    writes a file of another name; the manifest names the files that count.
    """
    spark = docs.sparkSession
    prepare(spark)
    folder = full_address(spark, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        cache, end, out, writer = json_file_cache(tokenizer), struct.pack("<I", end_id), None, None
        fs, path = shared_fs(folder)
        part = TaskContext.get().partitionId()
        name = f"tokens-{part:06d}-{uuid.uuid4().hex}.zst"
        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                if writer is None:
                    fs.create_dir(path, recursive=True)
                    out = fs.open_output_stream(f"{path}/{name}", compression=None)
                    writer = FrameWriter(out)
                writer.add(doc_id, cache.ids(text or "") + end)
        if writer is not None:
            writer.close()
            out.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in (part, f"{folder}/{name}", len(writer.docs), writer.tokens)], ["part", "file", "docs", "tokens"])

    ordered = docs.select("doc_id", "text").repartitionByRange(partitions(spark), "doc_id", F.xxhash64("text")).sortWithinPartitions(
        "doc_id", F.xxhash64("text"), "text")
    manifest = materialize(ordered.mapInArrow(run, "part long, file string, docs long, tokens long"), "token-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    return manifest.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)).cast("long"))


def read_token_files(manifest: DataFrame, wanted: list[int] | None = None) -> DataFrame:
    """(doc_id, start, ids binary) of all documents, or of the ids in ``wanted``, whose frames alone are decompressed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, start in zip(b.column("file").to_pylist(), b.column("start").to_pylist(), strict=True):
                fs, path = shared_fs(file)
                with fs.open_input_file(path) as f:
                    reader = FrameReader(f, f.size())
                    places = None if wanted is None else np.flatnonzero(reader.known & np.isin(reader.ids, wanted))
                    rows: list[tuple] = []
                    for i, ids in reader.read(places):
                        rows.append((int(reader.ids[i]) if reader.known[i] else None, start + int(reader.starts[i]), ids))
                        if len(rows) == 1000:
                            yield _batch(rows)
                            rows = []
                    if rows:
                        yield _batch(rows)

    def _batch(rows):
        a, b, c = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.binary())], ["doc_id", "start", "ids"])

    files = manifest.select("part", "file", "start").repartition(partitions(manifest.sparkSession), "part")
    return files.mapInArrow(run, "doc_id long, start long, ids binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_token_files(table(spark, sf_dir, "documents"), scratch_path(spark, "token-files"))
    return read_token_files(manifest).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
