import re
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).resolve().parent.parent


def test_names_and_sql_belong_together():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert {"p2_found", "p4_found", "p5_found"} <= set(entry.queries())


def test_core_does_not_import_the_subpackage():
    for p in (ROOT / "loomgraph").rglob("*.py"):
        if "llm" not in p.relative_to(ROOT).parts:
            assert not re.search(r"(from|import) loomgraph\.llm", p.read_text()), p


def test_flagship(spark):
    assert entry.entry(spark).columns == ["relation", "period", "side", "status", "n_refs"]
