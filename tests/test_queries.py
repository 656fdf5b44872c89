"""Every registered query against its SQL in DuckDB, at the smallest size."""

import glob
import math
import os

import duckdb
import pytest

from locusframe import queries_calls, queries_positions, queries_relations  # noqa: F401
from locusframe.registry import QUERIES, SQL

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(rows):
    def one(x):
        if x is None or isinstance(x, float) and math.isnan(x):
            return ""
        return f"{x:.6f}" if isinstance(x, float) else str(x)

    return sorted(tuple(one(x) for x in r) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = plain(df.select(*columns).collect())
    if name not in SQL:
        assert got
        return
    want = duck.execute(f'SELECT {", ".join(f"""q."{c}" """ for c in columns)} FROM ({SQL[name]}) q').fetchall()
    assert got == plain(want)
