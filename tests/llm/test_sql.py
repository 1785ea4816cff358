"""Queries against their SQL, on the smallest tables."""

import os
from pathlib import Path

import pytest

from passagemill.llm import registry

TABLES = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))


@pytest.mark.skipif(not TABLES.exists(), reason="the driver's tables are not here")
@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in TABLES.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    want = connection.execute(registry.ORACLES[name])
    names = [c[0] for c in want.description]
    got = registry.QUERIES[name](spark, str(TABLES))
    columns = sorted(got.columns)
    assert columns == sorted(names)
    rows = [tuple(r[names.index(c)] for c in columns) for r in want.fetchall()]
    assert sorted(map(tuple, got.select(*columns).collect()), key=str) == sorted(rows, key=str)


def test_each_operator_has_one_query():
    assert sorted(int(name[2:].split("_")[0]) for name in registry.QUERIES) == list(range(1, 14)) and set(registry.ORACLES) <= set(registry.QUERIES)
