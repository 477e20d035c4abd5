"""The driver contract with and without the text part."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__
from fleetmart.catalog import CATALOG

REPO = Path(__file__).parent.parent


def test_sql_is_registered_for_queries_only():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert set(CATALOG) <= set(__spark_entry__.oracle_sql())


@pytest.mark.parametrize("missing", ["zstandard", "tokenizers", "public_tokenizers", "corpus_pipeline", "fleetmart.llm"])
def test_queries_are_registered_without_a_text_library(missing):
    code = f"""
import sys
sys.modules[{missing!r}] = None
import __spark_entry__ as entry
found = entry.queries()
assert set(found) >= set(entry.CATALOG) and set(entry.oracle_sql()) >= set(entry.CATALOG)
print(sum(name.startswith("op") for name in found))
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=REPO, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    if missing != "tokenizers":  # looked for by tasks only
        assert done.stdout.strip() == "0"
