"""The entry works without the training-data operators, or without a library that only they need."""

from __future__ import annotations

import subprocess
import sys

import pytest
from conftest import ROOT

PROBE = """
import importlib.abc, sys, warnings
class Gone(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name == {name!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
with warnings.catch_warnings(record=True) as seen:
    warnings.simplefilter("always")
    queries, sql = e.queries(), e.oracle_sql()
assert any("training-data" in str(w.message) for w in seen)
assert "daily_active_users" in queries and set(sql) == set(queries) and not any(q.startswith("op") for q in queries)
"""


@pytest.mark.parametrize("name", ["regex", "viewlog.llm", "corpus_pipeline"])
def test_missing_modules_leave_the_other_queries(name):
    done = subprocess.run([sys.executable, "-c", PROBE.format(name=name)], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
