"""The registered queries without the corpus part or a library it needs."""

from __future__ import annotations

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
HIDDEN = """
import sys
sys.modules[{name!r}] = None
import __spark_entry__ as entry
names = set(entry.queries())
assert "monthly_school_metrics" in names and len(names) >= 81, len(names)
assert not any(n.startswith("op") and n[2].isdigit() for n in names)
assert set(entry.oracle_sql()) <= names
"""


@pytest.mark.parametrize("name", ["tiktoken", "xxhash", "schoolyard.llm", "schoolyard.llm.queries"])
def test_core_queries_do_not_need_the_corpus_part(name):
    ran = subprocess.run(
        [sys.executable, "-c", HIDDEN.format(name=name)], cwd=ROOT, capture_output=True, text=True, timeout=120
    )
    assert ran.returncode == 0, ran.stderr
