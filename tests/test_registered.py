"""Every registered query against its SQL on the smallest data set."""

import os

import duckdb
import pytest

from checks import oracle, registered

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_DIR}/{t}.parquet')")
    yield con
    con.close()


def near(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return abs(a - b) < 2e-4
    return a == b


def ordered(rows):
    key = lambda v: (v is None, f"{v:018.3f}" if isinstance(v, float) else str(v))
    return sorted(rows, key=lambda r: [key(v) for v in r])


@pytest.mark.parametrize("name", [q.__name__ for q in registered.QUERIES])
def test_query(spark, duck, name):
    df = registered.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    rows = ordered([tuple(r[c] for c in columns) for r in df.collect()])
    assert rows
    sql = oracle.oracle_sql().get(name)
    if sql is None:
        return
    result = duck.execute(sql)
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    want = ordered([tuple(r[i] for i in at) for r in result.fetchall()])
    assert len(rows) == len(want)
    for a, b in zip(rows, want):
        assert all(near(x, y) for x, y in zip(a, b)), (a, b)


def test_every_oracle_belongs_to_a_query():
    assert set(oracle.oracle_sql()) <= set(registered.queries())
