"""Golden records and edge values, validated in one pass over a small table."""

import copy
import json

import pytest
from pyspark.sql import functions as F

from tallyline.operators import validate

BASE = {
    "gtin": "8901234567890", "activation_date": "2026-02-10", "deactivation_date": "2027-02-10", "brand": "B",
    "name": "N", "description": "D", "category": "Beverages", "sub_category": "S", "company_detail": {"name": "C"},
    "hs_code": "1234", "igst": "18",
    "weights_and_measures": {"measurement_unit": "g", "net_content": "250 g", "gross_weight": "300", "net_weight": "250"},
    "mrp": [{"mrp": "10", "target_market": "India", "activation_date": "2026-02-10", "location": "Pune"}],
}
FOOD = {"category": "food", "attributes": {
    "regulatory_data": {"child": {"fssai_lic._no.": "11226998000057", "food_type": "Veg"}},
    "shelf_life": {"child": {"value": "12", "unit": "Months", "based_on": "Manufacturing Date"}}}}
NO_WEIGHTS = {"weights_and_measures": {"measurement_unit": "g", "net_content": "250 g"}}
WEIGHT_KEYS = ["gross_weight", "gross_weight_unit", "net_weight", "net_weight_unit"]


def rec(drop=(), **changes):
    r = copy.deepcopy(BASE)
    r.update(copy.deepcopy(changes))
    for k in drop:
        r.pop(k)
    return r


def price(**changes):
    return {"mrp": [{**BASE["mrp"][0], **changes}]}


def food(**changes):
    f = copy.deepcopy(FOOD)
    f["attributes"]["regulatory_data"]["child"].update(changes)
    return f


def measures(**changes):
    return {"weights_and_measures": {**BASE["weights_and_measures"], **changes}}


# name: (record, reasons as prefixes; None means the gate fails)
CASES = {
    "plain": (rec(), []),
    "numeric id": (rec(gtin=8901234567890), []),
    "dates and brand": (rec(activation_date="10-02-2026", brand=""), ["Activation Date", "Brand Name"]),
    "food complete": (rec(**FOOD), []),
    "food licence": (rec(**food(**{"fssai_lic._no.": "123"})), ["FSSAI NUMBER"]),
    "licence letters pass": (rec(**food(**{"fssai_lic._no.": "1abcdefghijklm"})), []),
    "blank licence stops the chain": (rec(**food(**{"fssai_lic._no.": "", "fssai_lic._no": "11226998000057"})),
                                      ["FSSAI NUMBER"]),
    "null licence falls through": (rec(**food(**{"fssai_lic._no.": None, "fssai_lic._no": "11226998000057"})), []),
    "category with space is not food": (rec(category="Food "), []),
    "other market needs no price": (rec(**price(target_market="UAE", mrp="")), []),
    "zero price": (rec(**price(mrp=0)), ["MRP:"]),
    "text price passes": (rec(**price(mrp="abc")), []),
    "false price": (rec(**price(mrp=False)), ["MRP:"]),
    "true price": (rec(**price(mrp=True)), []),
    "padded market": (rec(**price(target_market=" INDIA ", location="")), ["MRP Location"]),
    "gross below net, litres": (rec(**measures(measurement_unit="ml"), gross_weight="1", gross_weight_unit="L",
                                    net_weight="1200", net_weight_unit="ml"), ["Gross Weight vs Net Weight"]),
    "dimensions differ": (rec(gross_weight="1", gross_weight_unit="kg", net_weight="5000", net_weight_unit="ml"), []),
    "thousands comma": (rec(**measures(gross_weight="1,200", net_weight="2")), ["Gross Weight vs Net Weight"]),
    "piece unit": (rec(weights_and_measures={"measurement_unit": "each"}), []),
    "no weights": (rec(**NO_WEIGHTS), ["Gross Weight:", "Gross Weight Unit", "Net Weight:", "Net Weight Unit"]),
    "flat exemption": (rec(**NO_WEIGHTS, exempted_fields=WEIGHT_KEYS), []),
    "grouped exemption": (rec(**NO_WEIGHTS, exempted_fields=[{"fields": WEIGHT_KEYS}]), []),
    "mixed exemption": (rec(brand="", name="", exempted_fields=[" BRAND ", {"fields": ["name"]}, 5, None]), []),
    "number zero yields": (rec(gross_weight=0), []),
    "text zero wins": (rec(gross_weight="0"), ["Gross Weight vs Net Weight: Gross Weight (0 g)"]),
    "number form in message": (rec(**measures(gross_weight=100.0, net_weight=1e3)),
                               ["Gross Weight vs Net Weight: Gross Weight (100 g) is less than Net Weight (1000 g)"]),
    "unit missing": (rec(weights_and_measures={"net_content": "5", "gross_weight": "9"}, net_weight="5",
                         net_weight_unit="g"),
                     ["Gross Weight Unit", "Net Content Unit: Unit of measurement is missing. Net Content has value '5'"]),
    "no activation date": (rec(drop=["activation_date"]), ["Activation Date"]),
    "null activation date": (rec(activation_date=None), ["Activation Date"]),
    "shape is enough": (rec(activation_date="2026-99-99"), []),
    "padded date": (rec(activation_date=" 2026-04-07"), ["Activation Date"]),
    "date in a list": (rec(activation_date=["2026-04-07"]), []),
    "blank activation date": (rec(activation_date=""), None),
    "empty list date": (rec(activation_date=[]), None),
    "blank id": (rec(gtin="   "), None),
    "null price list": (rec(mrp=None), None),
    "odd price list": (rec(mrp=[BASE["mrp"][0], 3]), None),
    "null company": (rec(company_detail=None), None),
    "null measures": (rec(weights_and_measures=None), None),
    "list as company": (rec(company_detail=["x"]), None),
    "company absent": (rec(drop=["company_detail"]), ["Company Name"]),
    "empty list brand": (rec(brand=[]), ["Brand Name"]),
    "bracket text brand": (rec(brand="[x"), []),
    "hard space brand": (rec(brand=" \t"), ["Brand Name"]),
    "zero brand": (rec(brand=0), []),
    "odd attributes keep the rest": (rec(category="food", attributes={**FOOD["attributes"], "packaging": "x"}), []),
    "packaging weights": (rec(**NO_WEIGHTS, attributes={"packaging": {"child": {
        "gross_weight": {"child": {"value": 9, "unit": "g"}}, "net_weight": {"child": {"value": "8", "unit": "g"}}}}}),
        []),
}


@pytest.fixture(scope="module")
def results(spark):
    rows = [(name, json.dumps(r)) for name, (r, _) in CASES.items()] + [("not json", "oops"), ("scalar", "5")]
    frame = spark.createDataFrame(rows, "name string, raw string")
    made = {r["name"]: r for r in validate.validate_json(frame, ["name"]).collect()}
    variant = frame.withColumn("item", F.try_parse_json("raw"))
    other = {r["name"]: r for r in validate.validate_variant(variant, ["name"]).collect()}
    return made, other


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("path", [0, 1], ids=["text", "variant"])
def test_case(results, name, path):
    got, expected = results[path][name], CASES[name][1]
    if expected is None:
        assert got["reasons"] == ["Schema validation failed"] and not got["schema_valid"]
        return
    assert len(got["reasons"]) == len(expected), got["reasons"]
    for reason, prefix in zip(got["reasons"], expected):
        assert reason.startswith(prefix), reason
    assert got["validation_status"] == ("Rejected" if expected else "Accepted")


def test_unusable_records_fail_the_gate(results):
    assert not results[0]["not json"]["schema_valid"] and not results[0]["scalar"]["schema_valid"]
