"""Spark session defaults and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime settings every job relies on.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The JVM never compiles methods beyond 8000 bytes of code; wide rule stages
    # run faster as split projections than as one interpreted method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Plain case mapping: enough for the rule keywords, several times faster.
    "spark.sql.icu.caseMappings.enabled": "false",
    # A repeated key in one JSON object keeps its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


# Scratch folders of local sessions that came without spark.checkpoint.dir.
_local_roots: dict[str, str] = {}


def get_session(app: str = "tallyline", master: str | None = None, **settings: str) -> SparkSession:
    """Build (or fetch) a session. On a cluster leave ``master`` unset and pass
    ``spark.checkpoint.dir`` with the deployment's other settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**SQL_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_sql_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime settings on a session somebody else created."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder of
    its own; on a cluster the missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    app = spark.sparkContext.applicationId
    if app in _local_roots:
        return _local_roots[app]
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    _local_roots[app] = tempfile.mkdtemp(prefix="tallyline-")
    return _local_roots[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has used before."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes in here remove their shuffle files as they end, and not when the driver next collects its garbage: what a table was
    made from does not lie beside it while the next one is made."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def materialize(df, label: str):
    """Write a frame to the shared folder and read it back: later uses see the
    same rows even when an executor is lost and tasks are re-run."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
