"""The driver's contract, with and without the optional part."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def keys(setup: str) -> set[str]:
    code = f"import sys; sys.path.insert(0, {ROOT!r})\n{setup}\nimport __spark_entry__ as e\nassert set(e.oracle_sql()) <= set(e.queries())\nprint(*e.queries())"
    return set(subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.split())


def test_a_missing_library_takes_only_its_own_queries():
    whole = keys("")
    without = keys("sys.modules['zstandard'] = None")
    assert len(without) >= 91 and without <= whole and not [k for k in without if k.startswith("op")]
