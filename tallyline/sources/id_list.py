"""Id lists: delimited files with one of several header spellings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.functions import dates
from tallyline.functions import jsvals as js

# Header spellings per field, in order of preference.
HEADERS = {
    "gtin": ["Gtin", "gtin", "GTIN", "GTIN_number", "GTIN Number"],
    "created_at": ["Created at", "created_at", "Created At"],
    "updated_at": ["Updated at", "updated_at", "Updated At"],
    "product_status": ["Product status", "product_status", "Product Status"],
    "approval_status": ["Approval Status", "approval_status", "Approval status"],
}


def read(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    return spark.read.option("header", True).option("sep", sep).csv(path)


def _day(text: Column) -> Column:
    """A spreadsheet day number or the first ten characters of a date text."""
    serial = text.rlike(r"^\d+(\.\d+)?\z")
    return F.when(serial, dates.serial_to_date(text.try_cast("double")).cast("string")).otherwise(
        F.substring(text, 1, 10))


def load(rows: DataFrame, day: str | None = None, first_by: list[str] | None = None) -> DataFrame:
    """Listed ids once each with their cleaned attributes. ``day`` keeps rows of one
    creation day (rows without a date stay); ``first_by`` orders duplicates, the
    first one is kept. Without a known id header the first column is the id."""
    def column(field: str) -> Column:
        name = next((h for h in HEADERS[field] if h in rows.columns), None)
        if name is None and field == "gtin":
            name = rows.columns[0]
        return js.js_trim(F.col(f"`{name}`").cast("string")) if name else F.lit("")

    cleaned = {f: F.coalesce(column(f), F.lit("")) for f in HEADERS}
    for f in ("created_at", "updated_at"):
        cleaned[f] = _day(cleaned[f])
    order = first_by or []
    listed = rows.select(*[c.alias(n) for n, c in cleaned.items()], *[F.col(c).alias(f"_o_{c}") for c in order])
    listed = listed.filter(F.col("gtin") != "")
    if day:
        listed = listed.filter((F.col("created_at") == "") | (F.col("created_at") == day))
    keys = [F.col(f"_o_{c}") for c in order] + [F.col("created_at"), F.col("updated_at")]
    w = Window.partitionBy("gtin").orderBy(*keys)
    return listed.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").select(*HEADERS)
