"""Every named query against its SQL on the smallest tables."""

import math
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

from tallyforge.plans import ORACLES, QUERIES

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test data")


def plain(v):
    if isinstance(v, (bool, int)):
        return float(v)
    if isinstance(v, (float, Decimal)):
        return None if isinstance(v, float) and math.isnan(v) else round(float(v), 9)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v if v is None else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for f in SF.glob("*.parquet"):
        con.execute(f"create view {f.stem} as select * from read_parquet('{f}')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, str(SF))
    rows = [tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect()]
    if name in ORACLES:
        want = duck.execute(ORACLES[name])
        columns = [d[0] for d in want.description]
        order = sorted(range(len(columns)), key=lambda i: columns[i])
        assert sorted(columns) == sorted(df.columns)
        assert sorted(rows, key=repr) == sorted((tuple(plain(r[i]) for i in order) for r in want.fetchall()), key=repr)
    else:
        assert df.columns


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0 and set(e.oracle_sql()) <= set(e.queries())
