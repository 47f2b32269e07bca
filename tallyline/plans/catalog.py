"""All registered queries.

Days leave the catalogue as text: engines hand dates to their callers as different
types, text compares the same everywhere.
"""

from pyspark.sql import types as T

from tallyline.plans import q_publish, q_streaming, q_tables, q_validation  # noqa: F401 - they register queries
from tallyline.plans.registry import ORACLE as _ORACLE
from tallyline.plans.registry import QUERIES as _QUERIES

# Day columns by query.
DAYS = {
    "day": ["verdicts_for_day", "verdict_count_by_day", "verdicts_in_run_window", "latest_completed_run", "run_health",
            "day_run_totals", "run_outcomes", "continuity_verdict", "publish_dedup", "publish_chunks", "publish_slots",
            "verdicts_for_last_day", "verdicts_on_days", "coverage_summary", "coverage_missing", "coverage_missing_sample",
            "coverage_extra"],
    "from_date": ["resumable_run", "last_cursor_for_day", "latest_terminal_run", "active_run", "next_run_action"],
    "report_date": ["daily_summary"], "run_date": ["backfill_window_scan"], "from": ["run_report"], "to": ["run_report"],
}


def _as_text(query):
    def run(spark, sf_dir):
        df = query(spark, sf_dir)
        days = {f.name: df[f"`{f.name}`"].cast("string") for f in df.schema.fields if isinstance(f.dataType, T.DateType)}
        return df.withColumns(days) if days else df

    return run


def _sql_as_text(key: str, sql: str) -> str:
    columns = [c for c, keys in DAYS.items() if key in keys]
    casts = ", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in columns)
    return f"SELECT * REPLACE ({casts}) FROM ({sql})" if columns else sql


QUERIES = {key: _as_text(query) for key, query in _QUERIES.items()}
ORACLE = {key: _sql_as_text(key, sql) for key, sql in _ORACLE.items()}
