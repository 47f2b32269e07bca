"""WARC archives as a Spark data source.

``spark.read.format("warc")`` plans one partition for each archive. Filters on the record type, ids, target and digest
are pushed into the reader, which parses a record's headers first and jumps over the blocks of records that no filter
wants; with the option ``payload=false`` it never reads a payload. ``df.write.format("warc")`` writes one archive for
each task and, when all are done, a list of the archives that count, so that repeated tasks do no harm.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition,
                                    StringStartsWith, WriterCommitMessage)

from tallyline.llm.common import full_address, materialize, prepare, scratch_path, shared_fs, table

MIN_PAYLOAD = 100
DATE = "2024-01-01T00:00:00Z"
URN = "urn:tallyline:page:"
# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LIST_FILE = "_archives.json"
SCHEMA = ("record_type string, record_id string, target_uri string, date string, refers_to string, payload_digest string, "
          "payload_bytes long, payload binary")
HEADERS = {"record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "date": "WARC-Date",
           "refers_to": "WARC-Refers-To", "payload_digest": "WARC-Payload-Digest"}
BATCH_ROWS, BATCH_BYTES, READ_BYTES = 500, 8 << 20, 1 << 20


@dataclass
class Archive(InputPartition):
    file: str


@dataclass
class Written(WriterCommitMessage):
    file: str | None


def record(kind: str, page: str, url: str, digest: str, refers_to: str | None, payload: bytes, length: int) -> bytes:
    """One record; a revisit has the HTTP headers of its payload, which name its length, and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {length}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{URN}{page}>", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {quote(url, safe='%/:=&?~#+!$,;@()*[]') or URN + page}", f"WARC-Payload-Digest: sha256:{digest}",
            "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    if refers_to is not None:
        head[2:2] = [f"WARC-Refers-To: <{URN}{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    return VERSION + b"\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_headers(raw: bytes) -> dict[str, str]:
    """Header lines to a map; names are compared without case, folded lines are joined."""
    out: dict[str, str] = {}
    name = ""
    for line in raw.decode("utf-8", "replace").split("\r\n"):
        if line[:1] in (" ", "\t") and name:
            out[name] += " " + line.strip()
        elif ":" in line:
            name, _, value = line.partition(":")
            name = name.strip().lower()
            out[name] = value.strip()
    return out


class _Stream:
    """Forward reading of a file with a buffer; what is jumped over is not read if it lies behind the buffer."""

    def __init__(self, f):
        self.f, self.buffer, self.at, self.base = f, b"", 0, 0

    def _more(self, n: int) -> bool:
        got = self.f.read(max(n, READ_BYTES))
        self.base += self.at
        self.buffer, self.at = self.buffer[self.at:] + got, 0
        return bool(got)

    def until(self, mark: bytes) -> bytes | None:
        while (end := self.buffer.find(mark, self.at)) < 0:
            if not self._more(0):
                return None
        out, self.at = self.buffer[self.at:end], end + len(mark)
        return out

    def take(self, n: int) -> bytes:
        while len(self.buffer) - self.at < n:
            if not self._more(n - (len(self.buffer) - self.at)):
                raise ValueError("the archive ends inside a record")
        out, self.at = self.buffer[self.at:self.at + n], self.at + n
        return out

    def skip(self, n: int) -> None:
        if len(self.buffer) - self.at >= n:
            self.at += n
        else:
            self.base += self.at + n
            self.buffer, self.at = b"", 0
            self.f.seek(self.base)


def records(f, wanted, with_payload: bool) -> Iterator[dict]:
    """Rows of an open archive whose headers ``wanted`` accepts."""
    stream = _Stream(f)
    while (raw := stream.until(b"\r\n\r\n")) is not None:
        first, _, rest = raw.lstrip(b"\r\n").partition(b"\r\n")
        if not first.startswith(b"WARC/"):
            raise ValueError(f"not a record: {first[:40]!r}")
        head = parse_headers(rest)
        left = int(head["content-length"])
        row = {c: head.get(h.lower()) for c, h in HEADERS.items()}
        if wanted(row):
            row |= {"payload_bytes": None, "payload": None}
            if head.get("content-type", "").startswith("application/http"):
                http = stream.until(b"\r\n\r\n")
                left -= len(http) + 4
                length = parse_headers(http.partition(b"\r\n")[2]).get("content-length")
                row["payload_bytes"] = int(length) if length else left
            else:
                row["payload_bytes"] = left
            if with_payload and row["record_type"] != "revisit":
                row["payload"] = stream.take(left)
                left = 0
            yield row
        stream.skip(left + 4)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.with_payload = options["path"], str(options.get("payload", "true")).lower() == "true"
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if column in HEADERS and isinstance(f, EqualTo):
                self.tests.append((column, "in", (f.value,)))
            elif column in HEADERS and isinstance(f, In):
                self.tests.append((column, "in", tuple(f.value)))
            elif column in HEADERS and isinstance(f, StringStartsWith):
                self.tests.append((column, "starts", f.value))
            else:
                yield f

    def wanted(self, row: dict) -> bool:
        return all(row[c] is not None and (row[c] in v if how == "in" else row[c].startswith(v)) for c, how, v in self.tests)

    def partitions(self):
        from pyarrow import fs as pafs

        fs, path = shared_fs(self.path)
        info = fs.get_file_info(path)
        if info.type == pafs.FileType.File:
            return [Archive(self.path)]
        listed = fs.get_file_info(f"{path}/{LIST_FILE}")
        if listed.type == pafs.FileType.File:
            with fs.open_input_stream(listed.path) as f:
                names = json.loads(f.read())
        else:
            names = sorted(x.base_name for x in fs.get_file_info(pafs.FileSelector(path)) if x.base_name.endswith(".warc"))
        return [Archive(f"{self.path}/{n}") for n in names]

    def read(self, partition):
        if partition is None:  # no archive at all
            return
        fs, path = shared_fs(partition.file)
        schema = pa.schema([(c, pa.string()) for c in HEADERS] + [("payload_bytes", pa.int64()), ("payload", pa.binary())])
        with fs.open_input_file(path) as f:
            rows, size = [], 0
            for row in records(f, self.wanted, self.with_payload):
                rows.append(row)
                size += len(row["payload"] or b"")
                if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)


class WarcWriter(DataSourceArrowWriter):
    """Takes rows (page, url, payload, digest, payload_bytes, refers_to); refers_to makes a row a revisit."""

    def __init__(self, options: dict):
        self.path = options["path"]

    def write(self, iterator):
        fs, path = shared_fs(self.path)
        name, out = f"pages-{uuid.uuid4().hex}.warc", None
        for b in iterator:
            columns = [b.column(c).to_pylist() for c in ("page", "url", "payload", "digest", "payload_bytes", "refers_to")]
            for page, url, payload, digest, length, refers_to in zip(*columns, strict=True):
                if out is None:
                    fs.create_dir(path, recursive=True)
                    out = fs.open_output_stream(f"{path}/{name}", compression=None, buffer_size=READ_BYTES)
                kind = "response" if refers_to is None else "revisit"
                out.write(record(kind, page, url or "", digest, refers_to, payload or b"", length))
        if out is not None:
            out.close()
        return Written(name if out is not None else None)

    def commit(self, messages):
        fs, path = shared_fs(self.path)
        fs.create_dir(path, recursive=True)
        with fs.open_output_stream(f"{path}/{LIST_FILE}", compression=None) as f:
            f.write(json.dumps(sorted(m.file for m in messages if m and m.file)).encode())

    def abort(self, messages):
        fs, path = shared_fs(self.path)
        for m in messages:
            if m and m.file:
                fs.delete_file(f"{path}/{m.file}")


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)

    def writer(self, schema, overwrite):
        return WarcWriter(self.options)


def register(spark: SparkSession) -> None:
    prepare(spark, 500)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def write_pages(pages: DataFrame, folder: str, min_payload: int = MIN_PAYLOAD) -> None:
    """Write a record for every row of (page_id, url, html) into ``folder`` (a new shared folder).

    Of rows with equal payloads of at least ``min_payload`` bytes, those with the smallest page_id are responses and the
    others revisit it. A null html is an empty payload; a null url becomes the record's own id. A null page_id is never
    the smallest: such a row revisits the smallest other id, and is a response if there is none. Repeated rows give
    repeated records; further columns are not written.
    """
    register(pages.sparkSession)
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha2("payload", 256)).withColumn(
        "payload_bytes", F.octet_length("payload").cast("long"))
    first = rows.where(F.col("payload_bytes") >= min_payload).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL").select("digest", "first")
    joined = rows.join(materialize(first, "repeated-payloads"), "digest", "left")
    revisits = ~F.col("first").eqNullSafe(F.col("page_id"))
    joined.select(
        F.coalesce(F.col("page_id").cast("string"), F.lit("null")).alias("page"), "url",
        F.when(F.col("first").isNull() | ~revisits, F.col("payload")).alias("payload"), "digest", "payload_bytes",
        F.when(F.col("first").isNotNull() & revisits, F.col("first").cast("string")).alias("refers_to"),
    ).write.format("warc").mode("append").save(full_address(pages.sparkSession, folder))


def read_archive(spark: SparkSession, folder: str, payload: bool = True) -> DataFrame:
    register(spark)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(full_address(spark, folder))


def page_number(column: str) -> F.Column:
    """The page_id in a record id; null for a page without one."""
    return F.regexp_extract(column, f"^<{URN}(-?\\d+)>$", 1).try_cast("long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "archives")
    write_pages(table(spark, sf_dir, "pages"), folder)
    return read_archive(spark, folder).select(
        page_number("record_id").alias("page_id"), "payload_bytes",
        F.coalesce(F.sha2("payload", 256), F.regexp_replace("payload_digest", "^sha256:", "")).alias("payload_digest"),
        "record_type", page_number("refers_to").alias("refers_to"))


SQL = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= {MIN_PAYLOAD} GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN first <> page_id THEN first END AS refers_to FROM p LEFT JOIN f USING (payload_digest)
"""
