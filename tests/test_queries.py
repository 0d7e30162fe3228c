"""Every registered query of the core against its SQL on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from sieveline.plans import analysis, core, output  # noqa: E402

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES = core.QUERIES | analysis.QUERIES | output.QUERIES
ORACLES = core.ORACLES | analysis.ORACLES | output.ORACLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(x):
    if isinstance(x, float):
        return f"{x:.6g}"
    return str(x)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted("|".join(plain(r[i]) for i in order) for r in data)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    c = duck.execute(ORACLES[name])
    columns = [x[0] for x in c.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows(columns, c.fetchall())
