"""Every registered query with SQL gives the rows of its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from tessera.plans import all_queries

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = all_queries()

pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="the tables are not there")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


def rows(names, values):
    order = sorted(range(len(names)), key=names.__getitem__)
    show = lambda v: f"{v:.9g}" if isinstance(v, float) and not math.isnan(v) else str(v)
    return sorted(tuple(show(r[i]) for i in order) for r in values)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, name):
    df = QUERIES[name](spark, DIR)
    cursor = duck.execute(SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, df.collect()) == rows(names, cursor.fetchall())
