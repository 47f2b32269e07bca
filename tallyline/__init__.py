"""Validation and reporting of large product-record feeds as Spark jobs."""
