"""Record normalization: which fields are read, and how they are cleaned.

``read_fields`` parses the JSON text of a record once, with a schema that reads
every needed value as a string: keys no later step uses are never decoded, and
the rules work on strings and booleans only. A string hides the JSON type, so
where a text is ambiguous (is ``0`` a number? is ``[]`` a list?) the key is read
again as VARIANT; those branches run for the few records that need them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions import jsvals as js

# Top-level record keys the gate and the rules look at.
RECORD_KEYS = [
    "gtin", "activation_date", "deactivation_date", "brand", "name", "description", "category",
    "sub_category", "company_detail", "hs_code", "igst", "weights_and_measures", "gross_weight",
    "gross_weight_unit", "net_weight", "net_weight_unit", "measurement_unit", "net_content", "mrp",
    "attributes", "exempted_fields",
]

# Key and path of each value read as text, by the name used here.
# The first group keeps the exact printed form, the second only needs emptiness.
EXACT_PATHS = {
    "gtin": ("gtin", "$"),
    "gross_weight": ("gross_weight", "$"),
    "gross_weight_unit": ("gross_weight_unit", "$"),
    "net_weight": ("net_weight", "$"),
    "net_weight_unit": ("net_weight_unit", "$"),
    "measurement_unit": ("measurement_unit", "$"),
    "net_content": ("net_content", "$"),
    "wm_unit": ("weights_and_measures", "$.measurement_unit"),
    "wm_content": ("weights_and_measures", "$.net_content"),
    "wm_gross": ("weights_and_measures", "$.gross_weight"),
    "wm_net": ("weights_and_measures", "$.net_weight"),
    "pack_gross": ("attributes", "$.packaging.child.gross_weight.child.value"),
    "pack_gross_unit": ("attributes", "$.packaging.child.gross_weight.child.unit"),
    "pack_net": ("attributes", "$.packaging.child.net_weight.child.value"),
    "pack_net_unit": ("attributes", "$.packaging.child.net_weight.child.unit"),
    "mrp": ("mrp", "$[0].mrp"),
    "licence": ("attributes", "$.regulatory_data.child['fssai_lic._no.']"),
    "licence_2": ("attributes", "$.regulatory_data.child['fssai_lic._no']"),
    "licence_3": ("attributes", "$.regulatory_data.child.fssai_lic._no_"),
    "licence_4": ("attributes", "$.regulatory_data.child.fssai_lic._no"),
}
PRESENCE_PATHS = {
    "activation_date": ("activation_date", "$"),
    "deactivation_date": ("deactivation_date", "$"),
    "brand": ("brand", "$"),
    "name": ("name", "$"),
    "description": ("description", "$"),
    "category": ("category", "$"),
    "sub_category": ("sub_category", "$"),
    "company_name": ("company_detail", "$.name"),
    "hs_code": ("hs_code", "$"),
    "igst": ("igst", "$"),
    "target_market": ("mrp", "$[0].target_market"),
    "mrp_activation_date": ("mrp", "$[0].activation_date"),
    "mrp_location": ("mrp", "$[0].location"),
    "food_type": ("attributes", "$.regulatory_data.child.food_type"),
    "shelf_life_value": ("attributes", "$.shelf_life.child.value"),
    "shelf_life_unit": ("attributes", "$.shelf_life.child.unit"),
    "shelf_life_based_on": ("attributes", "$.shelf_life.child.based_on"),
}
# Values whose truthiness decides which one of several is used.
TRUTH_OF = [
    "gross_weight", "gross_weight_unit", "net_weight", "net_weight_unit", "measurement_unit", "net_content",
    "wm_unit", "wm_content", "wm_gross", "wm_net",
]


def text_schema(paths: list[tuple[str, str]], keys: list[str] = (), leaf_type: T.DataType = T.StringType()) -> T.StructType:
    """Schema that reads the value at every ``(key, path)`` as a string (or ``leaf_type``); a path
    through ``[0]`` makes its key a list. ``keys`` are read as well."""
    tree: dict = {key: None for key in keys}
    lists = {key for key, path in paths if path.startswith("$[0]")}
    for key, path in paths:
        steps = _steps(path)
        if not steps:
            tree[key] = None
            continue
        node = tree[key] = tree.get(key) or {}
        for step in steps[:-1]:
            node = node.setdefault(step, {})
        node[steps[-1]] = None

    def build(node) -> T.DataType:
        if node is None:
            return leaf_type
        return T.StructType([T.StructField(k, build(v)) for k, v in node.items()])

    return T.StructType([T.StructField(k, T.ArrayType(build(v)) if k in lists else build(v)) for k, v in tree.items()])


def _steps(path: str) -> list[str]:
    """Key names of a JSON path, without the list position."""
    body = path.removeprefix("$").removeprefix("[0]")
    head, _, quoted = body.partition("['")
    names = [n for n in head.split(".") if n]
    return names + ([quoted.removesuffix("']")] if quoted else [])


def leaf(record: Column, key: str, path: str) -> Column:
    value = record[key]
    if path.startswith("$[0]"):
        value = F.get(value, F.lit(0))
    for step in _steps(path):
        value = value[step]
    return value


TEXT_SCHEMA = text_schema([*EXACT_PATHS.values(), *PRESENCE_PATHS.values()], RECORD_KEYS)

# A number, optional space, then unit text. Backtracking is part of the meaning:
# "800" splits into 80 and 0, "5" does not split.
NET_CONTENT_PATTERN = rf"^([\d.]+){js.WS_CLASS}*([^\n\r\x{{2028}}\x{{2029}}]+)\z"


def typed_value(raw: Column, key: str) -> Column:
    """One top-level value with its JSON type, read from the text again."""
    return F.from_json(raw, T.StructType([T.StructField(key, T.VariantType())]))[key]


def read_fields(items: DataFrame, keep: list[str], raw: str = "raw") -> DataFrame:
    """Next to ``keep``: ``t_<name>`` texts, ``b_<name>`` truth flags, shape flags
    and exemptions of each record."""
    paths = {**EXACT_PATHS, **PRESENCE_PATHS}
    parsed = items.withColumn("_rec", F.from_json(F.col(raw), TEXT_SCHEMA))
    rec = F.col("_rec")

    def exact(key: str) -> Column:
        return typed_value(F.col(raw), key)

    def at(name: str) -> tuple:
        k, p = paths[name]
        return exact(k), p, leaf(rec, k, p)

    texts = {f"t_{n}": js.js_string(*at(n)) for n in EXACT_PATHS}
    texts |= {f"t_{n}": js.js_text(*at(n)) for n in PRESENCE_PATHS}
    truths = {f"b_{n}": js.js_truthy(*at(n)) for n in TRUTH_OF}
    # The licence chain stops at the first value that is not null, blank or not.
    licence = F.coalesce(*[texts.pop(f"t_{n}") for n in ("licence", "licence_2", "licence_3", "licence_4")])
    mrp_text = leaf(rec, *paths["mrp"])

    # A branch of WHEN reads the record again only where it is taken; in an OR Spark would share the
    # second parse as a common expression and run it for every record.
    def object_or_absent(key: str) -> Column:
        again = js.seldom(exact(key), lambda v: v.isNull() | js.is_object(v))
        return F.when(rec[key].isNotNull(), F.lit(True)).otherwise(again)

    def listed(entries: Column) -> Column:
        return F.coalesce(F.forall(entries, lambda e: e.isNotNull()), F.lit(False))

    shape = {
        "ok_company": object_or_absent("company_detail"),
        "ok_measures": object_or_absent("weights_and_measures"),
        # An element that is no object reads as NULL.
        "ok_mrp": F.when(listed(rec["mrp"]), F.lit(True)).otherwise(js.seldom(
            exact("mrp"), lambda v: v.isNull() | listed(F.try_variant_get(v, "$", "array<map<string,variant>>")))),
    }
    extra = {
        "t_licence": licence,
        "mrp_is_flag": F.when(mrp_text.isin("true", "false"),
                              F.schema_of_variant(js.js_get(exact("mrp"), "$[0].mrp")) == "BOOLEAN"),
        "exempt": F.when(rec["exempted_fields"].startswith("["), exemption_set(exact("exempted_fields")))
                   .otherwise(F.array().cast("array<string>")),
    }
    return parsed.select(*keep, *[c.alias(n) for n, c in {**texts, **truths, **shape, **extra}.items()])


def exemption_set(exempted: Column) -> Column:
    """Exempted rule keys, trimmed and lower-cased, from a list that mixes plain
    strings and ``{fields: [...]}`` groups. Anything but a list is empty."""
    entries = F.try_variant_get(exempted, "$", "array<variant>")

    def keys_of(entry: Column) -> Column:
        plain = F.when(F.schema_of_variant(entry) == "STRING", F.array(F.try_variant_get(entry, "$", "string")))
        group = F.transform(F.try_variant_get(entry, "$.fields", "array<variant>"),
                            lambda f: F.coalesce(js.js_string(f), F.lit("null")))
        return F.coalesce(plain, group, F.array().cast("array<string>"))

    keys = F.flatten(F.transform(entries, keys_of))
    return F.coalesce(F.transform(keys, lambda k: F.lower(js.js_trim(k))), F.array().cast("array<string>"))


def canonical_id(text: Column) -> Column:
    """Product id as trimmed text; absent and null give the empty string."""
    return F.coalesce(js.js_trim_column(text), F.lit(""))


def id_alias(items: DataFrame, item: str = "item") -> DataFrame:
    """Add ``gtin``: the first non-null of the id spellings, trimmed; NULL when blank."""
    spellings = [js.js_string(F.col(item), f"$.{k}") for k in ("gtin", "GTIN", "GTIN_number")]
    return items.withColumn("gtin", F.nullif(js.js_trim(F.coalesce(*spellings)), F.lit("")))


def lift_measures(df: DataFrame) -> DataFrame:
    """Canonical id, weights and weight units lifted to the top level.

    A top-level value wins unless it is falsy; a unit is lifted only when its
    (lifted) weight is truthy. ``b_*`` flags follow the value they describe.
    """
    def lifted(top: str, nested: str) -> dict[str, Column]:
        use_top = F.col(f"b_{top}") | ~F.col(f"b_{nested}")
        return {top: F.when(use_top, F.col(f"t_{top}")).otherwise(F.col(f"t_{nested}")),
                f"has_{top}": F.col(f"b_{top}") | F.col(f"b_{nested}")}

    def unit_of(top: str, weight: str, nested: str) -> dict[str, Column]:
        lift = ~F.col(f"b_{top}") & (F.col(f"b_{weight}") | F.col(f"b_{nested}")) & F.col("b_wm_unit")
        return {top: F.when(lift, F.col("t_wm_unit")).otherwise(F.col(f"t_{top}")),
                f"has_{top}": F.col(f"b_{top}") | lift}

    return df.withColumns({
        "gtin": canonical_id(F.col("t_gtin")),
        **lifted("gross_weight", "wm_gross"),
        **lifted("net_weight", "wm_net"),
        **unit_of("gross_weight_unit", "gross_weight", "wm_gross"),
        **unit_of("net_weight_unit", "net_weight", "wm_net"),
    })


def split_content(df: DataFrame) -> DataFrame:
    """Split ``"800 g"`` into value and unit and spread the parts.

    ``wm_unit``/``wm_content`` are what the rules read; ``measurement_unit`` and
    ``net_content`` are the top-level texts after filling.
    """
    content = F.when(F.col("b_wm_content"), js.js_trim(F.col("t_wm_content")))
    df = df.withColumns({
        "_value": F.nullif(F.regexp_extract(content, NET_CONTENT_PATTERN, 1), F.lit("")),
        "_rest": js.js_trim(F.regexp_extract(content, NET_CONTENT_PATTERN, 2)),
    })
    split = F.col("_value").isNotNull()

    def filled(top: str, parsed: str, nested: str) -> Column:
        text = F.col(f"t_{top}")
        fill = F.when(split, F.col(parsed)).when(F.col(f"b_{nested}"), F.col(f"t_{nested}")).otherwise(text)
        return F.when(F.col(f"b_{top}"), text).otherwise(fill)

    return df.withColumns({
        "wm_unit": F.when(split & ~F.col("b_wm_unit"), F.col("_rest")).otherwise(F.col("t_wm_unit")),
        "wm_content": F.when(split, F.col("_value")).otherwise(F.col("t_wm_content")),
        "measurement_unit": filled("measurement_unit", "_rest", "wm_unit"),
        "net_content": filled("net_content", "_value", "wm_content"),
    }).drop("_value", "_rest")


def normalize(df: DataFrame) -> DataFrame:
    return split_content(lift_measures(df))
