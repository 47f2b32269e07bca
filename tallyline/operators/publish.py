"""Publishing: column layout, one row per id, chunks and time slots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions import dates
from tallyline.functions import jsvals as js
from tallyline.operators import normalize
from tallyline.operators.ordering import with_position

CHUNK_ROWS = 5_000

# Minutes of the local day at which the day so far is published.
SLOT_TIMES = ["07:40", "09:10", "10:40", "12:10", "13:40", "15:10", "16:40", "18:10", "19:40", "21:10", "22:40"]

# Publish columns in order, each with the record paths that may hold
# it, first non-blank wins. "$" columns come from the verdict instead.
LAYOUT: dict[str, list[str]] = {
    "Company Name": ["['Company Name']", ".company_detail.name", ".company_name", ".companyName"],
    "GTIN": ["$gtin"],
    "AI Verified Status": ["$validation_status"],
    "AI Verified Reason": ["$reasons"],
    "GCP": [".GCP", ".gcp"],
    "Exempted fields": ["['Exempted fields']", ".exempted_fields"],
    "Category Name": ["['Category Name']", ".category", ".category_name", ".categoryName"],
    "Subcategory Name": ["['Subcategory Name']", ".sub_category", ".subcategory", ".subcategory_name"],
    "Product Name": ["['Product Name']", ".name", ".product_name", ".productName"],
    "Product Description": ["['Product Description']", ".description", ".product_description"],
    "Price": [".Price", ".price", ".mrp[0].mrp"],
    "Location MRP": ["['Location MRP']", ".mrp[0].location"],
    "Target Market": ["['Target Market']", ".target_market", ".mrp[0].target_market"],
    "Country of Origin": ["['Country of Origin']", ".country_of_origin"],
    "Approval Status": ["['Approval Status']", ".approval_status"],
    "Email": [".Email", ".email"],
    "Condition": [".Condition", ".condition"],
    "Brand Name": ["['Brand Name']", ".brand", ".brand_name", ".brandName"],
    "Gross Weight": ["['Gross Weight']", ".gross_weight"],
    "Gross Weight Unit": ["['Gross Weight Unit']", ".gross_weight_unit"],
    "Net Content": ["['Net Content']", ".net_content", ".weights_and_measures.net_content"],
    "Net Content Unit": ["['Net Content Unit']", ".net_content_unit"],
    "Net Weight": ["['Net Weight']", ".net_weight", ".weights_and_measures.net_weight"],
    "Net Weight Unit": ["['Net Weight Unit']", ".measurement_unit", ".weights_and_measures.measurement_unit"],
    "Packaging unit": ["['Packaging unit']", ".packaging_unit"],
    "Packaging type": ["['Packaging type']", ".packaging_type"],
    "modified_date": [".modified_date", "['Product Updated Date']", ".product_updated_date", ".updated_at"],
    "created_date": [".created_date", "['Product Created Date']", ".created_at"],
    "HS Code": ["['HS Code']", ".hs_code"],
    "Product Status": ["['Product Status']", ".product_status"],
    "Product SKU": ["['Product SKU']", ".product_sku", ".sku"],
    "Product Remarks": ["['Product Remarks']", ".product_remarks", ".remarks"],
    "Valid From": ["['Valid From']", ".activation_date"],
    "Valid Till": ["['Valid Till']", ".deactivation_date"],
    "Product Priority": ["['Product Priority']", ".product_priority"],
    "Product Parent SKU": ["['Product Parent SKU']", ".product_parent_sku"],
    "SGST": [".SGST", ".sgst"],
    "IGST": [".IGST", ".igst"],
    "CGST": [".CGST", ".cgst"],
    "Primary Depth": ["['Primary Depth']", ".primary_depth"],
    "Front Image": ["['Front Image']", ".front_image", ".images.front"],
    "Back Image": ["['Back Image']", ".back_image", ".images.back"],
    "Top Image": ["['Top Image']", ".top_image", ".images.top"],
    "Bottom Image": ["['Bottom Image']", ".bottom_image", ".images.bottom"],
    "Artwork Front": ["['Artwork Front']", ".artwork_front"],
    "Artwork Back": ["['Artwork Back']", ".artwork_back"],
    "Right Image": ["['Right Image']", ".right_image", ".images.right"],
    "Left Image": ["['Left Image']", ".left_image", ".images.left"],
    "Products Count": ["['Products Count']", ".products_count"],
}


# The record paths of the layout, each once, as (key, path inside the key).
PATHS = list(dict.fromkeys(p for listed in LAYOUT.values() for p in listed if not p.startswith("$")))


def _place(path: str) -> tuple[str, str]:
    if path.startswith("['"):
        return path[2:-2], "$"
    key = path[1:].partition(".")[0].removesuffix("[0]")
    return key, "$" + path[1 + len(key):]


_PLACES = [_place(p) for p in PATHS]


def _read(raw: Column, leaf_type: T.DataType) -> Column:
    """The record with the values of all paths as ``leaf_type``, from one parse. Its keys are numbered ``k0``, ``k1``..., as
    some differ in case only; what ``try_parse_json`` takes for no JSON is none here."""
    schema = normalize.text_schema(_PLACES, leaf_type=leaf_type)
    record = F.from_json(raw, schema, {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"})
    return record.cast(T.StructType([T.StructField(f"k{n}", f.dataType) for n, f in enumerate(schema)]))


_AT = {key: f"k{n}" for n, key in enumerate(dict.fromkeys(key for key, _ in _PLACES))}


def _values(record: Column) -> Column:
    return F.array(*[normalize.leaf(record, _AT[key], path) for key, path in _PLACES])


def _details(record: Column) -> list[tuple[str, Column]]:
    """Keys read as an object or list, with that object or the first of that list."""
    first = {key: path.startswith("$[0]") for key, path in _PLACES if path != "$"}
    return [(key, F.get(record[_AT[key]], F.lit(0)) if listed else record[_AT[key]]) for key, listed in first.items()]


def layout(verdicts: DataFrame, keep: list[str], raw: str = "raw") -> DataFrame:
    """Verdicts in the publish layout, read from the raw record: one parse reads the values of all paths as texts. A record
    with a text that may print in another form is parsed once more, with types, for those of its values; one that names a
    detail object or list without having it in that shape is read path by path."""
    at = {p: n for n, p in enumerate(PATHS)}

    def special(t: Column) -> Column:
        return F.when(t.isNull(), F.lit(False)).otherwise(js.reads_otherwise(t) | (t == "-0"))

    def misshapen(record: Column) -> Column:
        named = [F.when(inner.isNull(), F.contains(raw, F.lit(key)) | F.contains(raw, F.lit("\\u"))).otherwise(F.lit(False))
                 for key, inner in _details(record)]
        return F.coalesce(reduce(Column.__or__, named), F.lit(False))

    typed = js.seldom(_read(F.col(raw), T.VariantType()), _values)
    by_path = js.seldom(F.try_parse_json(raw), lambda v: F.array(*[js.js_get(v, "$" + p) for p in PATHS]))
    texts = (
        verdicts.withColumn("_record", _read(F.col(raw), T.StringType())).withColumn("_plain", _values(F.col("_record")))
        .withColumn("_odd", misshapen(F.col("_record")))
        .withColumn("_typed", F.when(F.col("_odd"), by_path).when(F.exists("_plain", special), typed))
        .withColumn("_texts", F.transform("_plain", lambda t, n: F.when(
            F.col("_odd") | special(t), js.js_trim(js.js_string(F.get("_typed", n)))).when(t.isNotNull(), js.js_trim(t))))
    )
    own = {"$gtin": F.coalesce("gtin", F.lit("")), "$validation_status": F.coalesce("validation_status", F.lit("")),
           "$reasons": F.array_join("reasons", "; ")}

    def value(listed: list[str]) -> Column:
        if listed[0] in own:
            return own[listed[0]]
        found = [F.get("_texts", F.lit(at[p])) for p in listed]
        return F.coalesce(*[F.nullif(f, F.lit("")) for f in found], F.lit(""))

    return texts.select(*keep, *[value(a).alias(c) for c, a in LAYOUT.items()])


def top_level_keys(raw: str = "raw") -> Column:
    return F.coalesce(F.size(F.array_distinct(F.json_object_keys(raw))), F.lit(0))


def richest(verdicts: DataFrame, raw: str = "raw") -> DataFrame:
    """Per day and id the verdict with the most top-level keys, ties to the
    earliest, with the place of the id's first appearance.

    Only ids and counts are grouped, in partial aggregates, so a hot id costs one
    row per task. ``n_keys`` is taken from the rows where they have it.
    """
    keys = F.col("n_keys") if "n_keys" in verdicts.columns else top_level_keys(raw)
    place = ["created_at", "batch_id", "item_pos"]
    first = F.min(F.struct(*place)).alias("first")
    best = F.min(F.struct((-keys).alias("neg_keys"), *place, "run_id")).alias("best")
    return verdicts.groupBy("day", "gtin").agg(first, best, F.count("*").alias("n_rows")).select(
        "day", "gtin", "n_rows", (-F.col("best.neg_keys")).alias("n_keys"),
        *[F.col(f"best.{c}").alias(c) for c in ("run_id", "batch_id", "item_pos", "created_at")],
        *[F.col(f"first.{c}").alias(f"first_{c}") for c in place])


def chunked(deduped: DataFrame, rows: int = CHUNK_ROWS) -> DataFrame:
    """Number the chunks of each day, ``rows`` rows each, by first appearance."""
    order = ["day", "first_created_at", "first_batch_id", "first_item_pos", "gtin"]
    placed = with_position(deduped, order)
    starts = placed.groupBy("day").agg(F.min("position").alias("_start"))
    numbered = placed.join(starts, "day").withColumn("row_no", F.col("position") - F.col("_start"))
    return numbered.withColumn("chunk_id", F.floor(F.col("row_no") / rows)).drop("_start", "position")


def payloads(rows: DataFrame, by: list[str], order: str, columns: list[str]) -> DataFrame:
    """One ``{"data": [...]}`` text per group; groups are bounded by the chunk size. A row becomes its text before the
    shuffle, so a group gathers texts and not wide rows."""
    entry = F.struct(order, F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns])).alias("row"))
    listed = F.array_join(F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["row"]), ",")
    return rows.groupBy(*by).agg(F.count("*").alias("n_rows"), F.concat(F.lit('{"data":['), listed, F.lit("]}")).alias("payload"))


def delivery_payloads(verdicts: DataFrame) -> DataFrame:
    """Delivery text per run and batch in the publish layout plus two older keys. A batch is one page of the feed
    and is sent whole."""
    rows = layout(verdicts, ["run_id", "batch_id", "item_pos"])
    rows = rows.withColumns({"GTIN_number": F.col("GTIN"), "Status": F.col("`AI Verified Status`")})
    return payloads(rows, ["run_id", "batch_id"], "item_pos", [*LAYOUT, "GTIN_number", "Status"])


def slot_counts(verdicts: DataFrame) -> DataFrame:
    """What each publish slot of a day would send: rows and distinct ids so far.

    An id counts from the first slot after its first appearance, so per-slot
    increments are enough; the running sums go over 11 rows per day.
    """
    minutes = [int(t[:2]) * 60 + int(t[3:]) for t in SLOT_TIMES]
    day_start = F.col("day").cast("timestamp_ntz")

    def slot(at: Column) -> Column:
        chain = F.when(at <= day_start + dates.minutes(minutes[0]), F.lit(0))
        for n, m in enumerate(minutes[1:], 1):
            chain = chain.when(at <= day_start + dates.minutes(m), F.lit(n))
        return chain

    seen = verdicts.groupBy("day", "gtin", slot(dates.local_time(F.col("created_at"))).alias("slot")).agg(
        F.count("*").alias("n"))
    first = seen.groupBy("day", "gtin").agg(F.min("slot").alias("slot"))
    ids = first.groupBy("day", "slot").agg(F.count("*").alias("ids"))
    rows = seen.groupBy("day", "slot").agg(F.sum("n").alias("rows"))
    slots = verdicts.select("day").distinct().select("day", F.posexplode(F.array(*[F.lit(t) for t in SLOT_TIMES]))
                                                     .alias("slot", "slot_time"))
    joined = slots.join(rows, ["day", "slot"], "left").join(ids, ["day", "slot"], "left")
    w = Window.partitionBy("day").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    return joined.select("day", "slot_time", F.coalesce(F.sum("rows").over(w), F.lit(0)).alias("rows_so_far"),
                         F.coalesce(F.sum("ids").over(w), F.lit(0)).alias("ids_so_far"))
