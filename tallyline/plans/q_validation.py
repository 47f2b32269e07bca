"""Queries on normalization, gate, exemptions, rules and verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions import dates
from tallyline.functions import jsvals as js
from tallyline.operators import normalize, reports, rules, validate
from tallyline.plans import fixtures, oracle
from tallyline.plans.oracle import query
from tallyline.plans.registry import register
from tallyline.plans.stores import landed_pages, path_of, store
from tallyline.session import scratch_path, shuffles_removed
from tallyline.sinks.day_log import read_days
from tallyline.sources import feed, synthetic


def _prepared(spark, sf_dir) -> DataFrame:
    return validate.prepared(normalize.read_fields(fixtures.items(spark, sf_dir), ["rid"]))


@register("validate_products", query("""
SELECT rid, vgtin AS gtin, validation_status, schema_valid, business_valid, reason_text AS reasons FROM verdicts""",
                                     "verdicts"))
def validate_products(spark, sf_dir):
    made = validate.validate_json(fixtures.items(spark, sf_dir), ["rid"])
    return made.select("rid", "gtin", "validation_status", "schema_valid", "business_valid",
                                             F.array_join("reasons", "; ").alias("reasons"))


@register("normalize_gtin", query("SELECT rid, n_gtin AS gtin FROM norm", "norm"))
def normalize_gtin(spark, sf_dir):
    return _prepared(spark, sf_dir).select("rid", "gtin")


@register("normalize_weights", query("""
SELECT rid, n_gross AS gross_weight, n_gross_unit AS gross_weight_unit, n_net AS net_weight,
  n_net_unit AS net_weight_unit FROM norm""", "norm"))
def normalize_weights(spark, sf_dir):
    return _prepared(spark, sf_dir).select("rid", "gross_weight", "gross_weight_unit", "net_weight", "net_weight_unit")


@register("split_net_content", query("""
SELECT rid, wm_unit, wm_content, CASE WHEN c_value IS NOT NULL THEN c_unit ELSE nullif(unit,'') END AS measurement_unit,
  CASE WHEN c_value IS NOT NULL THEN c_value ELSE nullif(net_content,'') END AS net_content FROM measures""",
                                     "measures"))
def split_net_content(spark, sf_dir):
    return _prepared(spark, sf_dir).select("rid", "wm_unit", "wm_content", "measurement_unit", "net_content")


@register("unit_value_swap", query("SELECT rid, r_unit AS unit, r_value AS value FROM swapped", "swapped"))
def unit_value_swap(spark, sf_dir):
    return _prepared(spark, sf_dir).select("rid", F.col("r_unit").alias("unit"), F.col("r_value").alias("value"))


@register("gross_net_compare", query("SELECT rid, below AS gross_below_net FROM flags", "flags"))
def gross_net_compare(spark, sf_dir):
    below = rules.gross_below_net(*[F.col(f"r_{c}") for c in ("gross", "gross_unit", "net", "net_unit")])
    return _prepared(spark, sf_dir).select("rid", below.alias("gross_below_net"))


@register("exemption_set", query("""
SELECT rid, array_to_string(list_sort(list_distinct(ex)),'|') AS exempted FROM flags""", "flags"))
def exemption_set(spark, sf_dir):
    return _prepared(spark, sf_dir).select(
        "rid", F.array_join(F.sort_array(F.array_distinct("exempt")), "|").alias("exempted"))


@register("schema_gate", query("SELECT rid, schema_valid FROM flags", "flags"))
def schema_gate(spark, sf_dir):
    return _prepared(spark, sf_dir).select("rid", "schema_valid")


def _rule_query(key, group, sql_rules):
    sql = query(f"SELECT rid, array_to_string({oracle.reasons(sql_rules)},'; ') AS reasons FROM flags", "flags")

    @register(key, sql)
    def run(spark, sf_dir):
        catalogue = group()
        flagged = rules.with_failures(_prepared(spark, sf_dir), catalogue)
        return flagged.select("rid", rules.reasons_text(catalogue).alias("reasons"))


_rule_query("rules_presence", rules.presence_rules, oracle.PRESENCE)
_rule_query("rules_weights", rules.weight_rules, oracle.WEIGHTS)
_rule_query("rules_mrp", rules.price_rules, oracle.PRICES)
_rule_query("rules_food", rules.food_rules, oracle.FOODS)


@register("reason_frequency", query("""
SELECT split_part(reason, ':', 1) AS rule, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM verdicts)
GROUP BY 1""", "verdicts"))
def reason_frequency(spark, sf_dir):
    return reports.reason_frequency(store(spark, sf_dir, "verdicts"))


@register("id_alias", query("""
SELECT rid, nullif(trim(gtin),'') AS gtin FROM products""", "products"))
def id_alias(spark, sf_dir):
    # The same id under three spellings, by record; other spellings hold a JSON null.
    p = fixtures.table(spark, sf_dir, "products")
    quoted = F.to_json(F.struct("gtin"))
    r = F.col("rid") % 3
    item = (F.when(r == 0, quoted)
            .when(r == 1, F.concat(F.lit('{"gtin":null,'), F.regexp_replace(quoted, r'^\{"gtin"', '"GTIN"')))
            .otherwise(F.regexp_replace(quoted, r'^\{"gtin"', '{"GTIN_number"')))
    return normalize.id_alias(p.select("rid", F.parse_json(item).alias("item"))).select("rid", "gtin")


@register("date_normalize", query(r"""
SELECT rid, CASE WHEN s IS NULL THEN NULL
  WHEN rid%4=0 THEN s WHEN rid%4=1 THEN CAST(CAST(stamp + INTERVAL 330 MINUTE AS DATE) AS VARCHAR)
  WHEN rid%4=2 THEN '2026-10-02' ELSE CASE WHEN regexp_matches(s,'^[0-9]{4}-') THEN left(s,10) ELSE s END END AS day
FROM (SELECT rid, deactivation_date AS s, created_at AS stamp FROM norm)""", "norm"))
def date_normalize(spark, sf_dir):
    p = fixtures.items(spark, sf_dir).select("rid", "created_at", "raw")
    s = F.get_json_object("raw", "$.deactivation_date")
    stamp = F.concat(F.regexp_replace(F.col("created_at").cast("string"), " ", "T"), F.lit("Z"))
    r = F.col("rid") % 4
    text = F.when(s.isNull(), None).when(r == 0, s).when(r == 1, stamp).when(r == 2, F.lit("10-02-2026")).otherwise(
        F.concat(s, F.lit(" (about)")))
    return p.select("rid", text.alias("s")).select("rid", dates.normalize_date(F.col("s")).alias("day"))


@register("date_window", query("""
SELECT run_id, CAST(from_date AS VARCHAR) AS window_from, CASE WHEN from_date=to_date
  THEN CAST(to_date AS VARCHAR)||'T23:59:59' ELSE CAST(CAST(to_date AS DATE) AS VARCHAR) END AS window_to
FROM runs""", "runs"))
def date_window(spark, sf_dir):
    start, end = F.col("from_date").cast("string"), F.col("to_date").cast("string")
    return fixtures.table(spark, sf_dir, "runs").select(
        "run_id", start.alias("window_from"), dates.widen_end(start, end).alias("window_to"))


@register("snapshot_key_profile", query("""
SELECT key, count(*) AS n FROM (SELECT unnest(list_filter(['gtin','company_detail','weights_and_measures','mrp',
  'attributes','brand','description','sub_category','hs_code',
  CASE WHEN activation_date IS NOT NULL THEN 'activation_date' END,
  CASE WHEN deactivation_date IS NOT NULL THEN 'deactivation_date' END, CASE WHEN name IS NOT NULL THEN 'name' END,
  CASE WHEN category IS NOT NULL THEN 'category' END, CASE WHEN igst IS NOT NULL THEN 'igst' END,
  CASE WHEN exempted IS NOT NULL THEN 'exempted_fields' END], lambda x: x IS NOT NULL)) AS key FROM products)
GROUP BY key""", "products"))
def snapshot_key_profile(spark, sf_dir):
    return reports.key_profile(fixtures.items(spark, sf_dir))


@register("synthetic_products", """
SELECT o_orderkey + 1 AS i, CAST(floor(o_orderkey/100) AS BIGINT) AS batch_no,
  '890'||lpad(CAST(o_orderkey+1 AS VARCHAR),10,'0') AS gtin, 'Rejected' AS validation_status, CAST(4 AS INT) AS n_reasons
FROM orders""")
def synthetic_products(spark, sf_dir):
    numbers = fixtures.table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 1).alias("i"))
    made = validate.validate_json(synthetic.products(numbers), ["i", "batch_no"])
    return made.select("i", "batch_no", "gtin", "validation_status", F.size("reasons").alias("n_reasons"))


# ---- landed pages

def landed(spark, sf_dir) -> DataFrame:
    """Pages written as compressed JSON lines and read back, as a feed job would find them."""
    path, pages = scratch_path(spark, "pages"), landed_pages(spark, sf_dir)
    with shuffles_removed(spark):
        pages.write.option("compression", "gzip").text(path)
    return feed.read_pages(spark, path)


@register("feed_scan", query("""
SELECT p.run_id, p.batch_id, CAST(b.source_page_seq AS BIGINT) AS source_page_seq, CAST(row_number() OVER (PARTITION BY
  p.run_id, p.batch_id ORDER BY item_pos) AS INT) AS item_pos, p.gtin
FROM products p JOIN batch_events b USING (run_id, batch_id)""", "products", "batch_events"))
def feed_scan(spark, sf_dir):
    rows = feed.page_items(landed(spark, sf_dir))
    return rows.select("run_id", "batch_id", "source_page_seq", "item_pos",
                       js.js_string(F.col("item"), "$.gtin").alias("gtin")).orderBy("run_id", "source_page_seq",
                                                                                    "item_pos")


@register("envelope_decode", query("""
SELECT run_id, batch_id, CAST(items_count AS INT) AS n_items, cursor_out AS next_cursor,
  CASE batch_id%5 WHEN 0 THEN false WHEN 1 THEN true ELSE cursor_out IS NOT NULL END AS has_next_page
FROM batch_events""", "batch_events"))
def envelope_decode(spark, sf_dir):
    pages = fixtures.landed_pages(spark, sf_dir).select(F.parse_json("value").alias("v"))
    return feed.page_header(pages).select("run_id", "batch_id", F.size("items").alias("n_items"), "next_cursor",
                                          "has_next_page")


@register("feed_distinct_by_page", query("""
SELECT count(DISTINCT run_id||'/'||batch_id) AS pages, count(DISTINCT nullif(trim(gtin),'')) AS unique_ids,
  count(DISTINCT nullif(trim(gtin),'')) >= 12000 AS reaches_target FROM products""", "products"))
def feed_distinct_by_page(spark, sf_dir):
    rows = normalize.id_alias(feed.page_items(landed(spark, sf_dir)))
    return reports.distinct_by_page(rows)


@register("quarantine", query("""
SELECT count(*) AS bad_lines, CAST(sum(length(doc)) AS BIGINT) AS bad_chars FROM (SELECT description||' {'||gtin AS doc FROM products)""", "products"))
def quarantine(spark, sf_dir):
    # Every item arrives once whole and once as a damaged line.
    damaged = fixtures.table(spark, sf_dir, "products").select(
        F.concat("description", F.lit(" {"), "gtin").alias("value"))
    lines = fixtures.items(spark, sf_dir).select(F.col("raw").alias("value")).unionByName(damaged)
    return feed.quarantine(lines).agg(F.count("*").alias("bad_lines"), F.sum(F.length("raw")).alias("bad_chars"))


@register("backfill_window_scan", query("""
SELECT run_date, count(*) AS n_items, count(DISTINCT batch_id) AS n_pages FROM products
WHERE run_date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' GROUP BY run_date""", "products"))
def backfill_window_scan(spark, sf_dir):
    rows = read_days(spark, path_of(spark, sf_dir, "item_days"), "1996-01-01", "1999-12-31", "run_date")
    return rows.groupBy("run_date").agg(F.count("*").alias("n_items"), F.countDistinct("batch_id").alias("n_pages"))
