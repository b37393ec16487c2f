"""Every registered query against its SQL twin on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="benchmark tables are not here")
QUERIES, ORACLE = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(FOLDER):
        if name.endswith(".parquet"):
            con.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{FOLDER}/{name}'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    clean = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    return [columns[i] for i in order], sorted(tuple(repr(clean(r[i])) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql_twin(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = duck.execute(ORACLE[name])
    expected = canonical([d[0] for d in cursor.description], cursor.fetchall())
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_twin_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() == 1
