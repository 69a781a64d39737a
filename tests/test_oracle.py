"""Every registered query against its SQL, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from skyfare.plans.oracle import ORACLE
from skyfare.plans.registry import QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def by_name(columns, records):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(r[i] for i in order) for r in records), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    cursor = duck.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert by_name(df.columns, df.collect()) == by_name(columns, cursor.fetchall())


def test_order_of_distance_ranking(spark):
    values = [r[1] for r in QUERIES["avg_distance_by_airport"](spark, DATA).collect()]
    assert values == sorted(values, reverse=True)


def test_entry(spark):
    assert entry(spark).count() == 20
