from __future__ import annotations

import re
from pathlib import Path

import __spark_entry__

ROOT = Path(__file__).resolve().parents[1]


def test_entry_has_a_row(spark):
    rows = __spark_entry__.entry(spark).collect()
    assert len(rows) == 1 and rows[0]["coverage_radius_max"] > 0


def test_sql_is_for_queries():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_every_query_of_the_engine_has_its_sql():
    from harvestry.plans import oracle, queries

    assert set(queries.QUERIES) == set(oracle.SQL)


def test_only_the_entry_imports_the_llm_subpackage():
    inside = [p for p in (ROOT / "harvestry").rglob("*.py") if "llm" not in p.relative_to(ROOT).parts]
    assert inside and not [p for p in inside if re.search(r"harvestry\.llm|corpus_pipeline", p.read_text())]


def test_nothing_uses_a_local_checkpoint_or_the_rdd_api():
    sources = [p for p in ROOT.rglob("*.py") if "tests" not in p.parts]
    assert not [p for p in sources if re.search(r"\.localCheckpoint\(|\.rdd\b", p.read_text())]


def test_public_names_are_there(spark):
    import harvestry

    assert all(getattr(harvestry, name) is not None for name in harvestry.__all__)
