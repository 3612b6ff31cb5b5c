"""Every base query against its SQL on the smallest tables."""

import math
from pathlib import Path

import pytest

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


def _names():
    from seamwright.plans import registry

    return sorted(registry.QUERIES)


def _norm(v):
    return ("nan" if math.isnan(v) else repr(round(v, 5) + 0.0)) if isinstance(v, float) else repr(v)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", _names())
def test_query(spark, duck, name):
    from seamwright.plans import registry

    df = registry.QUERIES[name](spark, str(DATA))
    rows = df.collect()
    if name not in registry.ORACLES:
        assert rows
        return
    got = duck.execute(registry.ORACLES[name])
    names = [c[0] for c in got.description]
    assert sorted(names) == sorted(df.columns)
    cols = sorted(names)
    want = sorted(tuple(_norm(r[names.index(c)]) for c in cols) for r in got.fetchall())
    assert sorted(tuple(_norm(r[c]) for c in cols) for r in rows) == want


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() >= 0
