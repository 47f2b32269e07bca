"""Business rules: exemptions, helper predicates and the ordered rule list.

A rule is ``(key, fails, message)``. The list order is the order of reasons in
the output. Exempting a key hides its reason; the other rules still run.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions import jsvals as js

# Units sold by the piece (no weight rules), spellings of mass and
# volume units with the factor to grams / millilitres, and rule parameters.
PIECE_UNITS = ["each", "piece", "pieces", "nos"]
MASS_UNITS = {"kg": 1000.0, "kilogram": 1000.0, "kilograms": 1000.0, "g": 1.0, "gram": 1.0, "grams": 1.0}
VOLUME_UNITS = {
    "l": 1000.0, "lt": 1000.0, "liter": 1000.0, "liters": 1000.0, "litre": 1000.0, "litres": 1000.0,
    "ml": 1.0, "milliliter": 1.0, "milliliters": 1.0, "millilitre": 1.0, "millilitres": 1.0,
}
HOME_MARKET = "india"
FOOD_CATEGORY = "food"
LICENCE_LENGTH = 14

# Reason texts by rule key, in reason order. Two texts carry values.
REASONS = {
    "gtin": "GTIN NUMBER: Should be provided",
    "activation_date": "Activation Date: invalid",
    "deactivation_date": "Deactivation Date: invalid",
    "brand": "Brand Name: Should be provided",
    "name": "Product Name: Should be provided",
    "description": "Product Description: Should be provided",
    "category": "Category: Not Accepted",
    "sub_category": "Sub Category: Not Accepted",
    "company_name": "Company Name: Not Accepted",
    "hs_code": "HS Code: Should be provided",
    "igst": "IGST: Should be provided",
    "gross_weight": "Gross Weight: Value is missing. Gross Weight must be provided.",
    "gross_weight_unit": "Gross Weight Unit: Unit of measurement is missing. "
                         "Gross Weight Unit (e.g. g, kg) must be provided.",
    "net_weight": "Net Weight: Value is missing. Net Weight must be provided.",
    "net_weight_unit": "Net Weight Unit: Unit of measurement is missing. "
                       "Net Weight Unit (e.g. g, kg, ml, L) must be provided.",
    "net_content_unit": "Net Content Unit: Unit of measurement is missing. "
                        "Net Content has value '{value}' but no unit is specified.",
    "weights": "Gross Weight vs Net Weight: Gross Weight ({gross} {gross_unit}) is less than "
               "Net Weight ({net} {net_unit}). Gross Weight must be greater than or equal to Net Weight.",
    "mrp": "MRP: Should be not be null and be positive",
    "target_market": "Target Market: Should be provided",
    "mrp_activation_date": "MRP Activation Date: Should be provided or be valid",
    "mrp_location": "MRP Location: Should be provided",
    "fssai_lic._no.": "FSSAI NUMBER: Should be of length 14 and should start with either 1 or 2",
    "food_type": "food_type: Not Accepted",
    "shelf_life_value": "Shelf Life Value: Should be provided",
    "shelf_life_unit": "Shelf Life Unit: Should be provided",
    "shelf_life_based_on": "Shelf Life Based On: Should be provided",
}


@dataclass(frozen=True)
class Rule:
    key: str
    fails: Column
    message: Column


def _template(text: str, **parts: Column) -> Column:
    """A message text with columns in place of its ``{name}`` marks."""
    out: list[Column] = []
    for piece in text.split("{"):
        name, closed, rest = piece.partition("}")
        if closed:
            out += [F.coalesce(parts[name], F.lit("")), F.lit(rest)]
        else:
            out.append(F.lit(piece))
    return F.concat(*out)


def order_unit_value(a: Column, b: Column) -> tuple[Column, Column]:
    """``(unit, value)`` of two lower-cased, trimmed texts given in either order:
    when exactly one is a number it is the value; otherwise the first is the unit."""
    swapped = js.is_trimmed_number(a) & ~js.is_trimmed_number(b)
    return F.when(swapped, b).otherwise(a), F.when(swapped, a).otherwise(b)


def _factor(unit: Column, table: dict[str, float]) -> Column:
    chain = None
    for factor in sorted(set(table.values())):
        names = [n for n, f in table.items() if f == factor]
        chain = (F.when if chain is None else chain.when)(unit.isin(names), F.lit(factor))
    return chain


def gross_below_net(gross: Column, gross_unit: Column, net: Column, net_unit: Column) -> Column:
    """True when both amounts are finite, of one dimension, and gross < net."""
    gu, nu = (F.lower(js.js_trim(u)) for u in (gross_unit, net_unit))
    g, n = js.js_parse_float(gross), js.js_parse_float(net)
    mass = g * _factor(gu, MASS_UNITS) < n * _factor(nu, MASS_UNITS)
    volume = g * _factor(gu, VOLUME_UNITS) < n * _factor(nu, VOLUME_UNITS)
    return F.coalesce(mass, volume, F.lit(False))


def rule_inputs(df: DataFrame) -> DataFrame:
    """Add ``r_*``: the values rules compare, each computed once.

    Weights fall back to the packaging attributes when the normalized top-level
    value is falsy.
    """
    def weight(top: str, packed: str) -> Column:
        return F.when(F.col(f"has_{top}"), F.col(top)).otherwise(F.col(f"t_{packed}"))

    df = df.withColumns({
        "r_gross": weight("gross_weight", "pack_gross"),
        "r_gross_unit": weight("gross_weight_unit", "pack_gross_unit"),
        "r_net": weight("net_weight", "pack_net"),
        "r_net_unit": weight("net_weight_unit", "pack_net_unit"),
        "_a": F.coalesce(F.lower(js.js_trim_column(F.col("wm_unit"))), F.lit("")),
        "_b": F.coalesce(F.lower(js.js_trim_column(F.col("wm_content"))), F.lit("")),
        "r_mrp": js.js_trim_column(F.col("t_mrp")),
    })
    unit, value = order_unit_value(F.col("_a"), F.col("_b"))
    return df.withColumns({
        "r_unit": unit,
        "r_value": value,
        "r_home": F.coalesce(F.lower(js.js_trim_column(F.col("t_target_market"))) == HOME_MARKET, F.lit(False)),
        "r_food": F.coalesce(F.lower("t_category") == FOOD_CATEGORY, F.lit(False)),
    }).drop("_a", "_b")


def _missing(key: str, *conditions: Column) -> Rule:
    fails = ~js.has_text(F.col(f"t_{key}"))
    for c in conditions:
        fails = c & fails
    return Rule(key, fails, F.lit(REASONS[key]))


def _bad_date(key: str, *conditions: Column) -> Rule:
    fails = ~js.is_iso_date(F.col(f"t_{key}"))
    for c in conditions:
        fails = c & fails
    return Rule(key, fails, F.lit(REASONS[key]))


def presence_rules() -> list[Rule]:
    return [
        Rule("gtin", ~js.has_text(F.col("gtin")), F.lit(REASONS["gtin"])),
        _bad_date("activation_date"),
        _bad_date("deactivation_date"),
        *[_missing(k) for k in ("brand", "name", "description", "category", "sub_category", "company_name",
                                "hs_code", "igst")],
    ]


def weight_rules() -> list[Rule]:
    gross, gross_unit, net, net_unit = (F.col(f"r_{c}") for c in ("gross", "gross_unit", "net", "net_unit"))
    unit, value = F.col("r_unit"), F.col("r_value")
    weighed = ~unit.isin(PIECE_UNITS)
    has = js.has_text
    complete = has(gross) & has(gross_unit) & has(net) & has(net_unit)
    return [
        Rule("gross_weight", weighed & ~has(gross), F.lit(REASONS["gross_weight"])),
        Rule("gross_weight_unit", weighed & ~has(gross_unit), F.lit(REASONS["gross_weight_unit"])),
        Rule("net_weight", weighed & ~has(net), F.lit(REASONS["net_weight"])),
        Rule("net_weight_unit", weighed & ~has(net_unit), F.lit(REASONS["net_weight_unit"])),
        Rule("net_content_unit", weighed & has(value) & ~has(unit),
             _template(REASONS["net_content_unit"], value=value)),
        Rule("weights", weighed & complete & gross_below_net(gross, gross_unit, net, net_unit),
             _template(REASONS["weights"], gross=gross, gross_unit=gross_unit, net=net, net_unit=net_unit)),
    ]


def price_rules() -> list[Rule]:
    home, mrp = F.col("r_home"), F.col("t_mrp")
    amount = F.when(F.col("mrp_is_flag"), (mrp == "true").cast("double")).otherwise(js.trimmed_number(F.col("r_mrp")))
    return [
        # Text that is no number compares as neither positive nor not, so it passes.
        Rule("mrp", home & (~js.has_text(mrp) | F.coalesce(amount <= 0, F.lit(False))), F.lit(REASONS["mrp"])),
        _missing("target_market"),
        _bad_date("mrp_activation_date", home),
        _missing("mrp_location", home),
    ]


def food_rules() -> list[Rule]:
    food, licence = F.col("r_food"), F.col("t_licence")
    good = js.has_text(licence) & (F.length(licence) == LICENCE_LENGTH) & F.substring(licence, 1, 1).isin("1", "2")
    return [
        Rule("fssai_lic._no.", food & ~F.coalesce(good, F.lit(False)), F.lit(REASONS["fssai_lic._no."])),
        *[_missing(k, food) for k in ("food_type", "shelf_life_value", "shelf_life_unit", "shelf_life_based_on")],
    ]


def all_rules() -> list[Rule]:
    return presence_rules() + weight_rules() + price_rules() + food_rules()


def with_failures(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add a flag ``fails_<n>`` per rule: it fails and its key is not exempted."""
    return df.withColumns({
        f"fails_{n}": r.fails & ~F.array_contains("exempt", r.key) for n, r in enumerate(rules)
    })


def reason_columns(rules: list[Rule]) -> list[Column]:
    return [F.when(F.col(f"fails_{n}"), r.message) for n, r in enumerate(rules)]


def reasons_array(rules: list[Rule]) -> Column:
    """Reasons in rule order, after ``with_failures`` of the same rules."""
    # Messages of different rules differ, so the set difference only drops NULLs
    # (and, unlike a lambda, it compiles together with the messages).
    return F.array_except(F.array(*reason_columns(rules)), F.array(F.lit(None).cast("string")))


def reasons_text(rules: list[Rule]) -> Column:
    """The same joined by ``"; "``; empty when nothing fails."""
    return F.concat_ws("; ", *reason_columns(rules))
