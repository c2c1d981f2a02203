"""Every registered query against its DuckDB oracle on the smallest tables, plus the entry."""

import math
from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry
from rrspark.plans.fixtures import BASE_TABLES
from rrspark.plans.queries import oracle_queries as oracle_sql
from rrspark.plans.queries import spark_queries as queries


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["value"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    missing = set(queries()) - set(oracle_sql())
    assert missing == set()


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    df = queries()[name](spark, sf_dir)
    rows = df.collect()
    rel = duck.sql(oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _bag(df.columns, rows) == _bag(rel.columns, rel.fetchall())
    assert not any(math.isnan(v) for r in rows for v in r if isinstance(v, float))
