"""Load-test products: one record per number, the same every time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_TOTAL, DEFAULT_BATCH = 45_000, 100


def record(i: Column) -> Column:
    """JSON text of load-test product ``i`` (from 1). Fixed values throughout;
    every third product is food, and none carries weights."""
    day, end = F.lit("2026-02-10"), F.lit("2026-12-10")
    price = F.struct(F.lit("100").alias("mrp"), F.lit("IN").alias("target_market"),
                     day.alias("activation_date"), F.lit("IN").alias("location"))
    licence = F.struct(F.struct(F.lit("12345678901234").alias("_no")).alias("fssai_lic"),
                       F.lit("veg").alias("food_type"))
    shelf = F.struct(F.lit("12").alias("value"), F.lit("month").alias("unit"), F.lit("mfg").alias("based_on"))
    return F.to_json(F.struct(
        F.concat(F.lit("890"), F.when(F.length(i.cast("string")) >= 10, i.cast("string")).otherwise(
            F.lpad(i.cast("string"), 10, "0"))).alias("gtin"),
        day.alias("activation_date"), end.alias("deactivation_date"), F.lit("Test Brand").alias("brand"),
        F.concat(F.lit("Product "), i.cast("string")).alias("name"), F.lit("Load test product").alias("description"),
        F.when(i % 3 == 0, "food").otherwise("non-food").alias("category"), F.lit("general").alias("sub_category"),
        F.struct(F.lit("ACME").alias("name")).alias("company_detail"), F.lit("1234").alias("hs_code"),
        F.lit("18").alias("igst"), F.lit("g").alias("measurement_unit"), F.lit("500").alias("net_content"),
        F.array(price).alias("mrp"),
        F.struct(F.struct(licence.alias("child")).alias("regulatory_data"),
                 F.struct(shelf.alias("child")).alias("shelf_life")).alias("attributes"),
    ))


def products(numbers: DataFrame, i: str = "i", batch: int = DEFAULT_BATCH) -> DataFrame:
    """``i``, its batch number and the record, for a frame of numbers."""
    n = F.col(i)
    return numbers.select(n.alias("i"), F.floor((n - 1) / batch).alias("batch_no"), record(n).alias("raw"))


def load_test(spark: SparkSession, total: int = DEFAULT_TOTAL, batch: int = DEFAULT_BATCH) -> DataFrame:
    return products(spark.range(1, total + 1).withColumnRenamed("id", "i"), batch=batch)
