"""Edge values of the JSON value functions and dates."""

import pytest
from pyspark.sql import functions as F

from tallyline.functions import dates
from tallyline.functions import jsvals as js


def column(spark, values, fn, parse=False):
    frame = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "n int, s string")
    col = F.parse_json("s") if parse else F.col("s")
    return [r[0] for r in frame.withColumn("c", col).orderBy("n").select(fn(F.col("c"))).collect()]


def test_string(spark):
    cases = {"300.0": "300", "1e3": "1000", "1e21": "1e+21", "1.5e-7": "1.5e-7", "2e-5": "0.00002", "0.5": "0.5",
             "8906183052619": "8906183052619", "true": "true", '"1e3"': "1e3", '"300.0"': "300.0", "null": None,
             '["a",1,null]': "a,1,", '[{"a":1},[2,3]]': "[object Object],2,3", '{"a":1}': "[object Object]",
             '"{x"': "{x", "[]": "", "1.23456789012345678e-5": "0.000012345678901234568",
             "1.234567890123456e-6": "0.000001234567890123456", "0.0000001": "1e-7", "-0.0000015": "-0.0000015",
             "1234567890123456789012": "1.2345678901234568e+21", "123456789012345678901": "123456789012345680000",
             "-2.50": "-2.5", "1e300": "1e+300", "0.0": "0", "100000.25": "100000.25", "12345678.5": "12345678.5"}
    assert column(spark, list(cases), js.js_string, parse=True) == list(cases.values())


def test_truthy(spark):
    cases = {"0": False, '"0"': True, "0.0": False, "-0": False, "false": False, '"false"': True, '""': False,
             "null": False, "[]": True, "{}": True, '" "': True, "1": True, "0e0": False}
    assert column(spark, list(cases), js.js_truthy, parse=True) == list(cases.values())


def test_number(spark):
    cases = {"": 0.0, "  ": 0.0, "5d": None, "250f": None, "inf": None, "1e3": 1000.0, "0x1F": 31.0, " 7 ": 7.0,
             ".5": 0.5, "5.": 5.0, ".": None, "1,2": None, "0b101": 5.0, "0o17": 15.0,
             "0b" + "0" * 64 + "11": 3.0, "0x" + "f" * 20: float(16**20), "0x": None, "0xg": None}
    assert column(spark, list(cases), js.js_number) == list(cases.values())
    assert column(spark, list(cases), js.is_js_number) == [v is not None for v in cases.values()]


def test_parse_float(spark):
    cases = {"1,200": 1.0, " 12 g": 12.0, "abc": None, "-3.5kg": -3.5, "1e": 1.0, ".5x": 0.5, "1e999": None}
    assert column(spark, list(cases), js.js_parse_float) == list(cases.values())


def test_iso_date(spark):
    cases = {"2026-99-99": True, "2026-04-07\n": False, " 2026-04-07": False, "": False}
    assert column(spark, list(cases), js.is_iso_date) == list(cases.values())


@pytest.mark.parametrize("text, day", [
    ("2026-03-04", "2026-03-04"), ("2026-03-04T20:00:00Z", "2026-03-05"), ("2026-03-04T20:00:00+05:30", "2026-03-04"),
    ("2026-03-04 23:59:59", "2026-03-04"), ("10-02-2026", "2026-10-02"), ("2026/04/07", "2026-04-07"),
    ("2026-03-04 or so", "2026-03-04"), ("soon", "soon"), ("02-31-2026", "2026-03-03")])
def test_normalize_date(spark, text, day):
    assert column(spark, [text], dates.normalize_date) == [day]


def test_serial_date(spark):
    assert str(column(spark, ["46085"], lambda c: dates.serial_to_date(c.cast("double")))[0]) == "2026-03-04"
