"""The driver's contract, with and without the training-data operators."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

REPO = Path(__file__).parent.parent


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 60


def test_entry_gives_rows(spark):
    assert entry.entry(spark).count() > 0


def test_the_rest_works_without_the_training_operators():
    code = (
        "import sys; sys.modules['corpus_pipeline'] = None; sys.modules['kpiloom.llm'] = None\n"
        "import __spark_entry__ as e; q = e.queries(); assert 'all_rules_union' in q and not any(n.startswith('op') for n in q) and 'pipeline' not in q; e.oracle_sql()"
    )
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True, timeout=120)


def test_nothing_else_imports_them():
    for f in (REPO / "kpiloom").rglob("*.py"):
        if "llm" not in f.parts:
            assert "kpiloom.llm" not in f.read_text()
