"""Structural gate: does a record have the shape the rules need?"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyline.functions import jsvals as js

# Fixed value: the only reason of a record that fails the gate.
GATE_REASON = "Schema validation failed"


def passes_gate() -> Column:
    """True when the id is not blank, the activation date does not read as blank
    (absent and null read as words, so they pass), the two detail objects are
    absent or objects, and the price list is absent or a list of objects."""
    activation = F.col("t_activation_date")
    return (
        (F.col("gtin") != "")
        & (activation.isNull() | js.has_text(activation))
        & F.col("ok_company") & F.col("ok_measures") & F.col("ok_mrp")
    )
