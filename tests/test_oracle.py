"""Every query against its SQL, as the driver compares them."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pytest

from harvestry.plans import oracle, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in Path(SF_DIR).glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def table(rows: list[tuple], names: list[str]) -> list[str]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(repr(tuple(0.0 if r[k] == 0 else r[k] for k in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, con, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    rows = [tuple(r) for r in df.collect()]
    assert rows
    if name in oracle.SQL:
        cursor = con.execute(oracle.SQL[name])
        names = [d[0] for d in cursor.description]
        assert sorted(names) == sorted(df.columns)
        assert table(rows, df.columns) == table(cursor.fetchall(), names)
