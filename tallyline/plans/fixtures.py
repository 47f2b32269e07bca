"""Input tables derived from the star schema, as SQL both engines can run.

Each text names its inputs as ``{table}``. Spark binds frames to those names;
``as_ctes`` turns the same texts into a WITH clause for the checking engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE_TABLES = ["nation", "supplier", "part", "orders", "lineitem", "events"]

PRODUCTS = """
WITH l AS (
  SELECT l_orderkey, l_linenumber, max(l_partkey) AS partkey, max(l_suppkey) AS suppkey,
         cast(max(l_quantity) AS int) AS qty, cast(floor(max(l_extendedprice)) AS bigint) AS price,
         max(l_shipdate) AS shipdate, chr(max(ascii(l_linestatus))) AS linestatus,
         l_orderkey*10+l_linenumber AS rid
  FROM {lineitem} GROUP BY l_orderkey, l_linenumber)
SELECT rid, cast(cast(o.o_orderdate AS date) AS string) || '#' || cast(l.l_orderkey%3 AS string) AS run_id,
  cast(o.o_orderdate AS date) AS run_date, cast(l.l_orderkey%3 AS int) AS run_slot, l.l_orderkey AS batch_id,
  l.l_linenumber AS item_pos,
  CASE WHEN rid%41=0 THEN '' WHEN rid%43=0 THEN '   '
       ELSE '890' || lpad(cast(partkey AS string),10,'0') END AS gtin,
  CASE WHEN rid%13=0 THEN '10-02-2026' WHEN rid%59=0 THEN '' WHEN rid%61=0 THEN NULL
       ELSE cast(cast(shipdate AS date) AS string) END AS activation_date,
  CASE WHEN rid%19=0 THEN NULL ELSE '2041-04-07' END AS deactivation_date,
  CASE WHEN rid%17=0 THEN '  ' ELSE p.p_brand END AS brand,
  CASE WHEN rid%53=0 THEN NULL ELSE p.p_name END AS name,
  p.p_name || ' ' || p.p_type AS description,
  CASE WHEN rid%31=0 THEN NULL WHEN p.p_type IN ('ECONOMY','PROMO') THEN 'Food' ELSE p.p_type END AS category,
  p.p_type AS sub_category,
  CASE WHEN rid%37=0 THEN '' ELSE s.s_name END AS company_name,
  lpad(cast(partkey AS string),8,'0') AS hs_code,
  CASE WHEN rid%29=0 THEN NULL ELSE '5' END AS igst,
  CASE rid%7 WHEN 0 THEN 'each' WHEN 1 THEN 'g' WHEN 2 THEN 'kg' WHEN 3 THEN 'ml' WHEN 4 THEN 'L'
             WHEN 5 THEN 'Gram' END AS unit,
  CASE rid%11 WHEN 0 THEN '5' WHEN 1 THEN cast(qty AS string) WHEN 2 THEN NULL
       ELSE cast(qty AS string) || ' ' || CASE rid%7 WHEN 0 THEN 'each' WHEN 3 THEN 'ml' ELSE 'g' END
       END AS net_content,
  CASE WHEN rid%23=0 THEN NULL WHEN rid%5=0 THEN cast(qty-1 AS string)
       ELSE cast(qty+5 AS string) END AS gross_weight,
  CASE WHEN rid%47=0 THEN NULL ELSE cast(qty AS string) END AS net_weight,
  CASE WHEN rid%9=0 THEN '0' WHEN rid%10=0 THEN 'abc' WHEN rid%14=0 THEN NULL
       ELSE cast(price AS string) END AS mrp,
  CASE rid%8 WHEN 0 THEN NULL WHEN 1 THEN 'UAE' WHEN 2 THEN ' INDIA ' ELSE 'India' END AS target_market,
  CASE WHEN rid%15=0 THEN '2026/04/07' ELSE '2026-04-07' END AS mrp_activation_date,
  CASE WHEN rid%16=3 THEN NULL ELSE n.n_name END AS mrp_location,
  CASE WHEN rid%6=0 THEN 'gross_weight|gross_weight_unit|net_weight|net_weight_unit'
       WHEN rid%25=0 THEN ' BRAND ' END AS exempted,
  rid%4 AS fssai_shape,
  CASE WHEN rid%21=0 THEN '31226998000057' WHEN rid%22=0 THEN '1122' ELSE '11226998000057' END AS fssai,
  CASE WHEN rid%33=0 THEN '' ELSE 'Veg' END AS food_type,
  CASE WHEN rid%34=0 THEN NULL ELSE '12' END AS shelf_value,
  'Months' AS shelf_unit, 'Manufacturing Date' AS shelf_based_on, linestatus
FROM l JOIN {orders} o ON l.l_orderkey=o.o_orderkey JOIN {part} p ON l.partkey=p.p_partkey
     JOIN {supplier} s ON l.suppkey=s.s_suppkey JOIN {nation} n ON s.s_nationkey=n.n_nationkey
"""

RUNS = """
WITH r AS (
  SELECT run_id, run_date, run_slot, cast(extract(day FROM run_date) AS int) AS d, count(*) AS n,
         count(DISTINCT batch_id) AS pages, sum(CASE WHEN linestatus='F' THEN 1 ELSE 0 END) AS f
  FROM {products} GROUP BY run_id, run_date, run_slot)
SELECT run_id, run_date AS from_date, run_date + (d%3) AS to_date, d, 100 AS result_per_page,
  'pending' AS status_filter,
  CASE d%5 WHEN 0 THEN 'RUNNING' WHEN 1 THEN 'PARTIAL_FAILED' WHEN 2 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  cast(run_date AS @TIMESTAMP) + INTERVAL '1' MINUTE * (20 + run_slot*540 + (d%12)*5) AS start_time,
  CASE WHEN d%5=0 THEN NULL ELSE cast(run_date AS @TIMESTAMP)
       + INTERVAL '1' MINUTE * (80 + run_slot*540 + (d%12)*5 + (d%4)*150) END AS end_time,
  pages AS pages_fetched, n + CASE WHEN d%7=0 THEN 3 ELSE 0 END AS items_fetched, n AS validated_count,
  cast(f AS bigint) AS delivered_count, cast(n - f AS bigint) AS delivery_failed_count,
  (d%5<>0 OR d%2=0) AS ingestion_completed
FROM r
"""

BATCH_EVENTS = """
SELECT run_id, batch_id, row_number() OVER (PARTITION BY run_id ORDER BY batch_id) AS source_page_seq, items_count,
  lag('c' || cast(batch_id AS string)) OVER (PARTITION BY run_id ORDER BY batch_id) AS cursor_in,
  CASE WHEN d%2=0 AND lead(batch_id) OVER (PARTITION BY run_id ORDER BY batch_id) IS NULL THEN NULL
       ELSE 'c' || cast(batch_id AS string) END AS cursor_out,
  'RAW_BATCH_ENQUEUED' AS event_type, d
FROM (SELECT run_id, batch_id, cast(extract(day FROM run_date) AS int) AS d, count(*) AS items_count
      FROM {products} GROUP BY run_id, batch_id, run_date) b
"""

CHECKPOINTS = """
SELECT run_id, source_page_seq, cursor_in, cursor_out FROM (
  SELECT b.*, row_number() OVER (PARTITION BY run_id ORDER BY source_page_seq DESC) AS rn
  FROM {batch_events} b) x WHERE rn=1 AND d%3<>0
"""

SNAPSHOTS = """
SELECT user_id AS run_no, event_id, ts, cast(floor(value) AS bigint) AS source_total,
  cast(sum(CASE WHEN event_type='purchase' THEN 1 ELSE 0 END)
       OVER (PARTITION BY user_id ORDER BY ts, event_id) AS bigint) AS items_fetched,
  CASE WHEN event_type='error' AND event_id%8=0 THEN 'PARTIAL_FAILED' ELSE 'RUNNING' END AS status
FROM {events}
"""

OUTBOX = """
SELECT o_orderkey AS outbox_id, o_custkey AS batch_id, cast(1 + o_orderkey%12 AS int) AS attempts,
  o_orderdate AS next_retry_at, CASE WHEN o_orderstatus='F' THEN 'DELIVERED' ELSE 'PENDING' END AS status,
  CASE o_custkey%5 WHEN 0 THEN NULL WHEN 1 THEN 200 WHEN 2 THEN 404 WHEN 3 THEN 429 ELSE 503 END AS http_status,
  cast(cast(o_orderdate AS date) AS string) || '#' || cast(o_orderkey%3 AS string) AS run_id,
  '{{"data":[' || cast(o_orderkey AS string) || ']}}' AS payload, 'status 500' AS last_error
FROM {orders}
"""

# Polls of the fetch report: clicks and purchases are fetches.
FETCH_STEPS, ALL_STEPS = "event_type='purchase'", "event_type IN ('click','purchase')"

TEXTS = {
    "products": PRODUCTS, "runs": RUNS, "batch_events": BATCH_EVENTS, "checkpoints": CHECKPOINTS,
    "snapshots": SNAPSHOTS, "outbox": OUTBOX,
}
NEEDS = {
    "products": ["lineitem", "orders", "part", "supplier", "nation"], "runs": ["products"],
    "batch_events": ["products"], "checkpoints": ["batch_events"], "snapshots": ["events"],
    "outbox": ["orders"],
}


def table(spark: SparkSession, sf_dir: str, name: str, **written: DataFrame) -> DataFrame:
    """A base table (its parquet file) or a derived one (a lazy plan over them); tables ``written`` are taken as they are."""
    if name in written:
        return written[name]
    if name not in TEXTS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = TEXTS[name].replace("@TIMESTAMP", "timestamp_ntz")
    needs = {n: table(spark, sf_dir, n, **written) for n in NEEDS[name]}
    if "lineitem" in needs:  # dealt once for the grouping and the join with the orders
        needs["lineitem"] = needs["lineitem"].repartition("l_orderkey")
    return spark.sql(text, **needs)


def cte(name: str) -> str:
    text = TEXTS[name].replace("@TIMESTAMP", "timestamp")
    return text.format(**{n: n for n in NEEDS[name]})


def start_time(run_date, run_slot):
    """Start of the run a product belongs to, from the product's own columns."""
    minutes = 20 + run_slot * 540 + F.pmod(F.dayofmonth(run_date), F.lit(12)) * 5
    return run_date.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), minutes.cast("int"))


def product_items(products: DataFrame, keep: list[str]) -> DataFrame:
    """Products as feed items: one JSON text ``raw`` per row. A NULL column is an
    absent key; the licence number sits under one of four keys and the exemption
    list has one of two shapes, as feeds deliver them."""
    c = F.col
    listed = F.split("exempted", r"\|")
    exempted = (
        F.when(c("exempted").isNull(), None)
        .when(c("rid") % 2 == 0, F.to_variant_object(listed))
        .otherwise(F.to_variant_object(F.array(F.struct(listed.alias("fields")))))
    )

    def licence(shape: int):
        return F.when(c("fssai_shape") == shape, c("fssai"))

    nested = F.when(c("fssai_shape") >= 2, F.struct(licence(2).alias("_no_"), licence(3).alias("_no")))
    regulatory = F.struct(licence(0).alias("fssai_lic._no."), licence(1).alias("fssai_lic._no"),
                          nested.alias("fssai_lic"), c("food_type"))
    shelf = F.struct(c("shelf_value").alias("value"), c("shelf_unit").alias("unit"),
                     c("shelf_based_on").alias("based_on"))
    record = F.struct(
        "gtin", "activation_date", "deactivation_date", "brand", "name", "description", "category", "sub_category",
        F.struct(c("company_name").alias("name")).alias("company_detail"), "hs_code", "igst",
        F.struct(c("unit").alias("measurement_unit"), "net_content", "gross_weight", "net_weight")
        .alias("weights_and_measures"),
        F.array(F.struct("mrp", "target_market", c("mrp_activation_date").alias("activation_date"),
                         c("mrp_location").alias("location"))).alias("mrp"),
        F.struct(F.struct(regulatory.alias("child")).alias("regulatory_data"),
                 F.struct(shelf.alias("child")).alias("shelf_life")).alias("attributes"),
        exempted.alias("exempted_fields"),
    )
    return products.select(*keep, F.to_json(record).alias("raw"))


ITEM_KEYS = ["rid", "run_id", "run_date", "batch_id", "item_pos", "created_at"]


def items(spark: SparkSession, sf_dir: str, **written: DataFrame) -> DataFrame:
    """Feed items with their run, page position and arrival time."""
    p = table(spark, sf_dir, "products", **written)
    arrival = start_time(F.col("run_date"), F.col("run_slot")) + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (F.col("rid") % 3600).cast("decimal(18,6)"))
    return product_items(p.withColumn("created_at", arrival), ITEM_KEYS)


def landed_pages(spark: SparkSession, sf_dir: str, **written: DataFrame) -> DataFrame:
    """Feed pages as landed JSON text. The item list hides under one of three keys;
    cursor and next-page flag sit at the top level or in ``pageInfo``."""
    # Dealt once by the keys of the join below, so that the records are moved once.
    rows = items(spark, sf_dir, **written).repartition("run_id", "batch_id").groupBy("run_id", "run_date", "batch_id").agg(
        F.sort_array(F.collect_list(F.struct("item_pos", "raw"))).alias("rows"))
    events = table(spark, sf_dir, "batch_events", **written).select("run_id", "batch_id", "source_page_seq", "cursor_in",
                                                         "cursor_out")
    b = F.col("batch_id")
    key = F.when(b % 3 == 0, "items").when(b % 3 == 1, "data").otherwise("products")
    listed = F.array_join(F.transform("rows", lambda r: r["raw"]), ",")
    flag = F.when(b % 5 == 0, ',"hasNextPage":false').otherwise("")
    nested_flag = F.when(b % 5 == 1, '"hasNextPage":true').otherwise("")
    cursor = F.coalesce(F.concat(F.lit('"nextCursor":"'), F.col("cursor_out"), F.lit('"')), F.lit('"nextCursor":null'))
    top = F.when(b % 2 == 0, F.concat(F.lit(","), cursor)).otherwise("")
    info = F.concat_ws(",", F.when(b % 2 == 1, cursor), F.nullif(nested_flag, F.lit("")))
    payload = F.concat(F.lit('{"'), key, F.lit('":['), listed, F.lit("]"), top, flag,
                       F.lit(',"pageInfo":{'), info, F.lit("}}"))
    head = F.to_json(F.struct(
        F.col("run_id").alias("runId"), b.alias("batchId"), F.col("run_date").cast("string").alias("fromDate"),
        F.col("source_page_seq").alias("sourcePageSeq"), F.col("cursor_in").alias("cursorIn")))
    page = F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"payload":'), payload, F.lit("}"))
    return rows.join(events, ["run_id", "batch_id"]).select("run_id", "run_date", "batch_id", "source_page_seq",
                                                            page.alias("value"))
