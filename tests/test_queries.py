"""Every query with SQL against DuckDB on the same tables."""

import math
from pathlib import Path

import duckdb
import pytest

from strataloom.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = lambda v: round(v, 5) if isinstance(v, float) and math.isfinite(v) else v
    return [columns[i] for i in order], sorted((tuple(plain(v[i]) for i in order) for v in values), key=str)


@pytest.mark.parametrize("name", list(registry.ORACLE_SQL))
def test_query(spark, db, name):
    df = registry.QUERIES[name](spark, SF)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    con = db.execute(registry.ORACLE_SQL[name])
    want = rows([c[0] for c in con.description], con.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]
    assert got[1]
