"""Landed feed pages: reading, envelope decoding, windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions import jsvals as js

# Keys that may hold the item list of a page, in order of preference.
LIST_KEYS = ["items", "data", "products"]

UNPARSEABLE = "unparseable page"
# A page cut into texts: every value as it is written, so that items are parsed once, by the validation.
_PAGE = "runId string, batchId string, fromDate string, sourcePageSeq string, payload string, _bad string"
_PAYLOAD = ", ".join(f"{k} string" for k in LIST_KEYS)
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}

def parse_pages(lines: DataFrame) -> DataFrame:
    """Text lines ``value`` with their VARIANT ``v``, NULL where they do not parse."""
    return lines.filter(F.trim("value") != "").withColumn("v", F.try_parse_json("value"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages, a JSON line each: their text ``value`` and VARIANT ``v``."""
    return parse_pages(spark.read.text(path))


def stream_lines(spark: SparkSession, path: str, files_per_trigger: int = 200) -> DataFrame:
    """Landed pages as a stream of their texts. ``files_per_trigger`` bounds each batch; pages beyond it wait for the next
    one, none is dropped."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path)


def stream_pages(spark: SparkSession, path: str, files_per_trigger: int = 200) -> DataFrame:
    """The same as a stream."""
    return parse_pages(stream_lines(spark, path, files_per_trigger))


def decode_envelope(pages: DataFrame, payload: Column) -> DataFrame:
    """Add ``items`` (first list among the known keys, else empty), ``next_cursor``
    (top level before ``pageInfo``) and ``has_next_page`` (an explicit flag, else
    whether there is a cursor)."""
    lists = [F.try_variant_get(payload, f"$.{k}", "array<variant>") for k in LIST_KEYS]

    def flag(path: str) -> Column:
        v = js.js_get(payload, path)
        return F.when(F.schema_of_variant(v) == "BOOLEAN", F.try_variant_get(payload, path, "boolean"))

    cursor = F.coalesce(*[js.js_string(payload, f"$.{p}") for p in ("nextCursor", "pageInfo.nextCursor")])
    decoded = pages.withColumns({
        "items": F.coalesce(*lists, F.array().cast("array<variant>")),
        "next_cursor": cursor,
    })
    has_cursor = F.coalesce(F.col("next_cursor") != "", F.lit(False))
    return decoded.withColumn("has_next_page", F.coalesce(flag("$.hasNextPage"), flag("$.pageInfo.hasNextPage"),
                                                          has_cursor))


def page_header(pages: DataFrame, v: str = "v") -> DataFrame:
    """Run, batch, day and sequence of a landed page, and its decoded payload."""
    def text(path: str) -> Column:
        return F.try_variant_get(v, path, "string")

    head = pages.withColumns({
        "run_id": text("$.runId"), "batch_id": F.try_variant_get(v, "$.batchId", "long"),
        "from_date": text("$.fromDate"), "source_page_seq": F.try_variant_get(v, "$.sourcePageSeq", "long"),
        "cursor_in": text("$.cursorIn"), "payload": js.js_get(F.col(v), "$.payload"),
    })
    return decode_envelope(head, F.col("payload")).drop("payload")


def page_items(pages: DataFrame, v: str = "v") -> DataFrame:
    """One row per item of every readable page, with its place in the page; ``quarantine`` has the others."""
    good = pages.filter(F.col(v).isNotNull())
    keep = ["run_id", "batch_id", "from_date", "source_page_seq"]
    return page_header(good, v).select(*keep, F.posexplode("items").alias("pos", "item")).select(
        *keep, (F.col("pos") + 1).alias("item_pos"), "item")


def page_item_texts(lines: DataFrame, unreadable: bool = True) -> DataFrame:
    """One row per item of every page of ``value``, the item as its JSON text, in one pass over the page; a page that is no
    JSON is one row without an item, ``readable`` false, with its text in ``page``, or none without ``unreadable``."""
    parsed = lines.filter(F.trim("value") != "").select("value", F.from_json(
        "value", _PAGE, {**_STRICT, "columnNameOfCorruptRecord": "_bad"}).alias("p"))
    # The typed parse also objects to JSON that is no object; only the full parse tells those from broken text.
    readable = F.col("p._bad").isNull() | F.try_parse_json("value").isNotNull()
    payload = F.from_json("p.payload", _PAYLOAD, _STRICT)
    head = parsed.select("value", "p", readable.alias("readable"), payload.alias("d"))
    listed = F.coalesce(*[F.when(F.col(f"d.{k}").startswith("["), F.col(f"d.{k}")) for k in LIST_KEYS])
    none = F.array(F.lit(None).cast("string")) if unreadable else F.lit(None).cast("array<string>")
    cut = head.select(
        F.col("p.runId").alias("run_id"), F.col("p.batchId").try_cast("long").alias("batch_id"), F.col("p.fromDate").alias("from_date"),
        F.col("p.sourcePageSeq").try_cast("long").alias("source_page_seq"), "readable", F.when(~F.col("readable"), F.col("value")).alias("page"),
        F.when(F.col("readable"), F.from_json(listed, "array<string>", _STRICT)).otherwise(none).alias("texts"))
    # The outer form and a filter of its result: a filter of the texts would be moved before the parses and repeat them.
    return cut.select("run_id", "batch_id", "from_date", "source_page_seq", "readable", "page", F.posexplode_outer("texts").alias("pos", "item")).where(
        "pos IS NOT NULL").withColumn("item_pos", F.col("pos") + 1).drop("pos")


def quarantine(lines: DataFrame, raw: str = "value") -> DataFrame:
    """Lines that are no JSON, with a reason."""
    return lines.filter(F.try_parse_json(F.col(raw)).isNull()).select(
        F.col(raw).alias("raw"), F.lit(UNPARSEABLE).alias("problem"))


def page_events(lines: DataFrame) -> DataFrame:
    """One event for each readable page of ``value``: run, batch, sequence, items and cursors."""
    head = page_header(parse_pages(lines).where("v IS NOT NULL"))
    return head.select("run_id", "batch_id", "source_page_seq", F.size("items").cast("long").alias("items_count"), "cursor_in",
                       F.col("next_cursor").alias("cursor_out"), F.lit("RAW_BATCH_ENQUEUED").alias("event_type"))


# Keys that may hold the id of an item, in order of preference.
ID_KEYS = ["gtin", "GTIN", "GTIN_number"]


def page_ids(lines: DataFrame) -> DataFrame:
    """(run_id, batch_id, day, item_pos, gtin) of every item of the readable pages of ``value``; an item without an id has
    a null ``gtin``."""
    def found(key: str) -> Column:
        def read(kind: str) -> Column:
            return F.from_json("item", f"{key} {kind}", _STRICT)[key]

        return js.js_string(read("variant"), "$", read("string"))

    # The id is read once, and trimmed in a step of its own.
    items = page_item_texts(lines, unreadable=False).withColumn("gtin", F.coalesce(*[found(k) for k in ID_KEYS]))
    return items.select("run_id", "batch_id", F.col("from_date").try_cast("date").alias("day"), "item_pos",
                        F.nullif(js.js_trim(F.col("gtin")), F.lit("")).alias("gtin"))
