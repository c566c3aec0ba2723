"""Every registered query with SQL gives DuckDB's rows on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__
from grantlink.plans import queries

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canonical(rows):
    def one(v):
        if v is None or isinstance(v, float) and math.isnan(v):
            return "null"
        return str(v) if isinstance(v, (str, bool)) or not hasattr(v, "__float__") else f"{float(v):.6g}"

    return sorted(tuple(map(one, r)) for r in rows)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    result = duck.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert canonical(df.select(*columns).collect()) == canonical([[r[i] for i in order] for r in result.fetchall()])


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
