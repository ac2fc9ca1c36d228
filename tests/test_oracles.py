"""Every query with an oracle gives the oracle's rows; every other one runs."""

import os

import duckdb
import pytest
from pyspark.sql import SparkSession
from vellum.plans import catalogue

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        if os.path.exists(f"{FOLDER}/{t}.parquet"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and value != value):
        return "null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int | float):
        return f"{float(value):.9g}"
    if hasattr(value, "isoformat"):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark: SparkSession, duck, name):
    df = catalogue.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    sql = catalogue.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    result = duck.sql(sql)
    assert sorted(result.columns) == columns
    at = [result.columns.index(c) for c in columns]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in result.fetchall())
