"""Queries against their SQL, on the smallest tables, and the entry module's guard."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

from passagemill.plans import catalog

REPO = Path(__file__).resolve().parent.parent
TABLES = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))


def shown(rows):
    return sorted(tuple("-" if v is None else str(v) for v in r) for r in rows)


@pytest.mark.skipif(not TABLES.exists(), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", ["paragraph_spans", "evidence_order", "paragraph_qa_records", "qualification_decision", "gold_closure", "null_safe_support", "evaluation_rules", "build_paragraph_qa_qualified", "build_knowledge_unit_probed_qa", "stage_outputs", "unit_lineage", "identifier_grammars", "composite_handoffs", "paragraph_handoffs", "provenance_problems", "provenance_anchors", "slot_merge", "forbidden_copy_fields", "imported_rules"])
def test_query_equals_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    got = catalog.QUERIES[name](spark, str(TABLES))
    want = connection.execute(catalog.ORACLES[name])
    columns = sorted(got.columns)
    names = [c[0] for c in want.description]
    assert columns == sorted(names)
    assert shown(got.select(*columns).collect()) == shown([[r[names.index(c)] for c in columns] for r in want.fetchall()])


def test_every_query_has_a_name_in_both():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES) and len(catalog.QUERIES) >= 45


def test_entry_imports_without_llm(tmp_path):
    for name in ("passagemill", "__spark_entry__.py"):
        (tmp_path / name).symlink_to(REPO / name) if name.endswith(".py") else None
    (tmp_path / "passagemill").mkdir()
    for p in (REPO / "passagemill").iterdir():
        if p.name not in ("llm", "__pycache__"):
            (tmp_path / "passagemill" / p.name).symlink_to(p)
    code = "import sys; sys.path.insert(0, sys.argv[1]); import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') for k in q) and 'pipeline' not in q"
    # a copy: the import path must not lead back to this repository
    (tmp_path / "__spark_entry__.py").unlink()
    (tmp_path / "__spark_entry__.py").write_text((REPO / "__spark_entry__.py").read_text())
    done = subprocess.run([sys.executable, "-c", code, str(tmp_path)], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert done.returncode == 0, done.stderr
