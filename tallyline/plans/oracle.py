"""The same answers as plain SQL over the flat product columns.

Shared steps are named CTEs; ``query(text, *names)`` puts the ones a query needs
in front of it, in order.
"""

from __future__ import annotations

from tallyline.plans import fixtures

_WS = r"chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||' '"

CTES: dict[str, tuple[list[str], str]] = {
    name: ([n for n in fixtures.NEEDS[name] if n in fixtures.TEXTS], fixtures.cte(name)) for name in fixtures.TEXTS
}

CTES["norm"] = (["products"], r"""
SELECT p.*, CAST(extract(day FROM run_date) AS INT) AS d,
  CAST(run_date AS TIMESTAMP) + INTERVAL '1' MINUTE * (20 + run_slot*540 + (extract(day FROM run_date)%12)*5)
    + INTERVAL '1' SECOND * (rid%3600) AS created_at,
  trim(gtin) AS n_gtin,
  nullif(gross_weight,'') AS n_gross, nullif(net_weight,'') AS n_net,
  CASE WHEN nullif(gross_weight,'') IS NOT NULL THEN nullif(unit,'') END AS n_gross_unit,
  CASE WHEN nullif(net_weight,'') IS NOT NULL THEN nullif(unit,'') END AS n_net_unit,
  nullif(regexp_extract(trim(coalesce(net_content,'')), '^([0-9.]+)\s*(.+)$', 1),'') AS c_value,
  trim(regexp_extract(trim(coalesce(net_content,'')), '^([0-9.]+)\s*(.+)$', 2)) AS c_unit
FROM products p""")

CTES["measures"] = (["norm"], r"""
SELECT n.*,
  CASE WHEN c_value IS NOT NULL THEN coalesce(nullif(unit,''), c_unit) ELSE unit END AS wm_unit,
  CASE WHEN c_value IS NOT NULL THEN c_value ELSE net_content END AS wm_content
FROM norm n""")

_NUM = r"'^([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)?$'"

CTES["swapped"] = (["measures"], rf"""
SELECT s.*,
  CASE WHEN regexp_matches(a,{_NUM}) AND NOT regexp_matches(b,{_NUM}) THEN b ELSE a END AS r_unit,
  CASE WHEN regexp_matches(a,{_NUM}) AND NOT regexp_matches(b,{_NUM}) THEN a ELSE b END AS r_value
FROM (SELECT m.*, lower(trim(coalesce(wm_unit,''))) AS a, lower(trim(coalesce(wm_content,''))) AS b
      FROM measures m) s""")

_FACTOR = ("CASE WHEN {u} IN ('kg','kilogram','kilograms','l','lt','liter','liters','litre','litres') THEN 1000.0 "
           "WHEN {u} IN ('g','gram','grams','ml','milliliter','milliliters','millilitre','millilitres') THEN 1.0 END")
_DIM = ("CASE WHEN {u} IN ('kg','kilogram','kilograms','g','gram','grams') THEN 'mass' "
        "WHEN {u} IN ('l','lt','liter','liters','litre','litres','ml','milliliter','milliliters','millilitre',"
        "'millilitres') THEN 'volume' END")

CTES["flags"] = (["swapped"], rf"""
SELECT q.*,
  coalesce(g_dim = n_dim AND gross_num*g_factor < net_num*n_factor, false) AS below
FROM (SELECT s.*,
  (trim(n_gtin)<>'' AND (activation_date IS NULL OR trim(activation_date)<>'')) AS schema_valid,
  r_unit NOT IN ('each','piece','pieces','nos') AS weighed,
  coalesce(trim(n_gross),'')<>'' AS has_g, coalesce(trim(n_gross_unit),'')<>'' AS has_gu,
  coalesce(trim(n_net),'')<>'' AS has_n, coalesce(trim(n_net_unit),'')<>'' AS has_nu,
  coalesce(lower(trim(target_market))='india', false) AS home, coalesce(lower(category)='food', false) AS food,
  list_transform(string_split(coalesce(exempted,''),'|'), lambda x: lower(trim(x))) AS ex,
  TRY_CAST(n_gross AS DOUBLE) AS gross_num, TRY_CAST(n_net AS DOUBLE) AS net_num,
  {_FACTOR.format(u="lower(trim(n_gross_unit))")} AS g_factor, {_FACTOR.format(u="lower(trim(n_net_unit))")} AS n_factor,
  {_DIM.format(u="lower(trim(n_gross_unit))")} AS g_dim, {_DIM.format(u="lower(trim(n_net_unit))")} AS n_dim
FROM swapped s) q""")

_BLANK = "coalesce(trim({c}),'')=''"
_BAD_DATE = r"NOT regexp_matches(coalesce({c},''), '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')"


def _rule(key: str, fails: str, message: str) -> str:
    return f"CASE WHEN ({fails}) AND NOT list_contains(ex,'{key}') THEN {message} END"


def _text(message: str) -> str:
    return "'" + message.replace("'", "''") + "'"


PRESENCE = [
    _rule("gtin", _BLANK.format(c="n_gtin"), _text("GTIN NUMBER: Should be provided")),
    _rule("activation_date", _BAD_DATE.format(c="activation_date"), _text("Activation Date: invalid")),
    _rule("deactivation_date", _BAD_DATE.format(c="deactivation_date"), _text("Deactivation Date: invalid")),
    _rule("brand", _BLANK.format(c="brand"), _text("Brand Name: Should be provided")),
    _rule("name", _BLANK.format(c="name"), _text("Product Name: Should be provided")),
    _rule("description", _BLANK.format(c="description"), _text("Product Description: Should be provided")),
    _rule("category", _BLANK.format(c="category"), _text("Category: Not Accepted")),
    _rule("sub_category", _BLANK.format(c="sub_category"), _text("Sub Category: Not Accepted")),
    _rule("company_name", _BLANK.format(c="company_name"), _text("Company Name: Not Accepted")),
    _rule("hs_code", _BLANK.format(c="hs_code"), _text("HS Code: Should be provided")),
    _rule("igst", _BLANK.format(c="igst"), _text("IGST: Should be provided")),
]
WEIGHTS = [
    _rule("gross_weight", "weighed AND NOT has_g",
          _text("Gross Weight: Value is missing. Gross Weight must be provided.")),
    _rule("gross_weight_unit", "weighed AND NOT has_gu",
          _text("Gross Weight Unit: Unit of measurement is missing. Gross Weight Unit (e.g. g, kg) must be provided.")),
    _rule("net_weight", "weighed AND NOT has_n",
          _text("Net Weight: Value is missing. Net Weight must be provided.")),
    _rule("net_weight_unit", "weighed AND NOT has_nu",
          _text("Net Weight Unit: Unit of measurement is missing. "
                "Net Weight Unit (e.g. g, kg, ml, L) must be provided.")),
    _rule("net_content_unit", "weighed AND trim(r_value)<>'' AND trim(r_unit)=''",
          "'Net Content Unit: Unit of measurement is missing. Net Content has value '''||r_value||"
          "''' but no unit is specified.'"),
    _rule("weights", "weighed AND has_g AND has_gu AND has_n AND has_nu AND below",
          "'Gross Weight vs Net Weight: Gross Weight ('||n_gross||' '||n_gross_unit||') is less than Net Weight ('"
          "||n_net||' '||n_net_unit||'). Gross Weight must be greater than or equal to Net Weight.'"),
]
PRICES = [
    _rule("mrp", "home AND (coalesce(trim(mrp),'')='' OR coalesce(TRY_CAST(trim(mrp) AS DOUBLE)<=0,false))",
          _text("MRP: Should be not be null and be positive")),
    _rule("target_market", _BLANK.format(c="target_market"), _text("Target Market: Should be provided")),
    _rule("mrp_activation_date", "home AND " + _BAD_DATE.format(c="mrp_activation_date"),
          _text("MRP Activation Date: Should be provided or be valid")),
    _rule("mrp_location", "home AND " + _BLANK.format(c="mrp_location"), _text("MRP Location: Should be provided")),
]
FOODS = [
    _rule("fssai_lic._no.",
          "food AND NOT (coalesce(trim(fssai),'')<>'' AND length(fssai)=14 AND left(fssai,1) IN ('1','2'))",
          _text("FSSAI NUMBER: Should be of length 14 and should start with either 1 or 2")),
    _rule("food_type", "food AND " + _BLANK.format(c="food_type"), _text("food_type: Not Accepted")),
    _rule("shelf_life_value", "food AND " + _BLANK.format(c="shelf_value"),
          _text("Shelf Life Value: Should be provided")),
    _rule("shelf_life_unit", "food AND " + _BLANK.format(c="shelf_unit"),
          _text("Shelf Life Unit: Should be provided")),
    _rule("shelf_life_based_on", "food AND " + _BLANK.format(c="shelf_based_on"),
          _text("Shelf Life Based On: Should be provided")),
]


def reasons(rules: list[str]) -> str:
    return "list_filter([" + ",\n".join(rules) + "], lambda x: x IS NOT NULL)"


CTES["verdicts"] = (["flags"], f"""
SELECT v.*, CASE WHEN len(reasons)=0 THEN 'Accepted' ELSE 'Rejected' END AS validation_status,
  len(reasons)=0 AS business_valid, array_to_string(reasons,'; ') AS reason_text
FROM (SELECT rid, run_id, run_date, batch_id, item_pos, created_at, schema_valid,
  CASE WHEN schema_valid THEN n_gtin ELSE gtin END AS vgtin,
  CASE WHEN schema_valid THEN {reasons(PRESENCE + WEIGHTS + PRICES + FOODS)}
       ELSE ['Schema validation failed'] END AS reasons
  FROM flags) v""")

# Current verdict per id: the last one written.
CTES["current"] = (["verdicts"], """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vgtin ORDER BY created_at DESC, batch_id DESC,
  item_pos DESC) AS rn FROM verdicts) WHERE rn=1""")

CTES["run_days"] = (["runs"], "SELECT *, CAST(start_time + INTERVAL 330 MINUTE AS DATE) AS ist_day FROM runs")


def query(text: str, *names: str) -> str:
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name in done:
            return
        for need in CTES[name][0]:
            add(need)
        done[name] = CTES[name][1]

    for name in names:
        add(name)
    if not done:
        return text
    return "WITH " + ",\n".join(f"{n} AS ({t})" for n, t in done.items()) + "\n" + text


CTES["counters"] = (["verdicts"], """
SELECT run_id, count(*) AS validated, count(*) FILTER (WHERE validation_status='Accepted') AS accepted_count,
  count(*) FILTER (WHERE schema_valid AND validation_status='Rejected') AS rejected_count,
  count(*) FILTER (WHERE NOT schema_valid) AS schema_invalid FROM verdicts GROUP BY run_id""")
CTES["runs_full"] = (["runs", "counters"], """
SELECT r.*, c.accepted_count, c.rejected_count, c.schema_invalid,
  CAST(r.start_time + INTERVAL 330 MINUTE AS DATE) AS ist_day FROM runs r JOIN counters c USING (run_id)""")
CTES["polls"] = (["snapshots"], """
SELECT *, lag(source_total) OVER w AS p_total, lag(items_fetched) OVER w AS p_items, lag(ts) OVER w AS p_ts
FROM snapshots WINDOW w AS (PARTITION BY run_no ORDER BY ts, event_id)""")
CTES["day_cursor"] = (["runs", "checkpoints", "batch_events"], """
SELECT r.run_id, r.from_date, r.start_time, r.status, r.ingestion_completed, r.items_fetched, 0 AS src, c.cursor_out,
  c.source_page_seq FROM runs r JOIN checkpoints c USING (run_id) WHERE c.cursor_out IS NOT NULL
UNION ALL
SELECT r.run_id, r.from_date, r.start_time, r.status, r.ingestion_completed, r.items_fetched, 1, b.cursor_out,
  b.source_page_seq FROM runs r JOIN batch_events b USING (run_id) WHERE b.cursor_out IS NOT NULL""")
CTES["resumable"] = (["day_cursor"], """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY from_date ORDER BY src, start_time DESC, run_id DESC,
  source_page_seq DESC) AS rn FROM day_cursor WHERE status IN ('RUNNING','PARTIAL_FAILED') AND NOT ingestion_completed)
WHERE rn=1""")
