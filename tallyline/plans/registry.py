"""Where query functions and their SQL counterparts are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def add(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn

    return add
