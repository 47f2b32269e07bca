"""Raw items to verdicts: normalize, gate, rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.operators import gate, normalize, rules

ACCEPTED, REJECTED = "Accepted", "Rejected"

VERDICT_COLUMNS = ["gtin", "validation_status", "reasons", "schema_valid", "business_valid"]


def prepared(fields: DataFrame) -> DataFrame:
    """Normalized fields plus the rule inputs and the gate result."""
    return rules.rule_inputs(normalize.normalize(fields)).withColumn("schema_valid", gate.passes_gate())


def verdicts(fields: DataFrame, keep: list[str]) -> DataFrame:
    """One verdict per record. ``keep`` names the input columns to carry along.

    No shuffle: the whole chain is a projection of the scan. Records that fail
    the gate are rejected with one fixed reason and keep their raw, untrimmed id.
    """
    catalogue = rules.all_rules()
    checked = rules.with_failures(prepared(fields), catalogue)
    reasons = rules.reasons_array(catalogue)
    checked = checked.select(
        *keep,
        F.when(F.col("schema_valid"), F.col("gtin"))
        .otherwise(F.coalesce("t_gtin", F.lit(""))).alias("gtin"),
        F.when(F.col("schema_valid"), reasons).otherwise(F.array(F.lit(gate.GATE_REASON))).alias("reasons"),
        "schema_valid",
    )
    clean = F.size("reasons") == 0
    return checked.select(
        *keep, "gtin",
        F.when(clean, F.lit(ACCEPTED)).otherwise(F.lit(REJECTED)).alias("validation_status"),
        "reasons", "schema_valid", clean.alias("business_valid"),
    )


def validate_json(items: DataFrame, keep: list[str], raw: str = "raw") -> DataFrame:
    return verdicts(normalize.read_fields(items, keep, raw), keep)


def validate_variant(items: DataFrame, keep: list[str], item: str = "item") -> DataFrame:
    """The same for VARIANT items, as decoded from a page."""
    return validate_json(items.withColumn("_item", F.to_json(item)), keep, "_item")
