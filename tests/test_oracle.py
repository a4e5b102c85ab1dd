"""Every job query against its SQL in DuckDB."""

import os
from pathlib import Path

import duckdb
import pytest

from careerlake.queries import ORACLE_SQL, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from '{p}'")
    return c


def plain(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(v):
        return round(float(v), 8) if isinstance(v, int | float) and not isinstance(v, bool) else str(v)

    return sorted([[value(r[i]) for i in order] for r in rows], key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    if name not in ORACLE_SQL:
        assert got
        return
    want = duck.execute(ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(df.columns)
    assert plain(got, df.columns) == plain(want.fetchall(), names)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
