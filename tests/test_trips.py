"""Itineraries put together from small tables, and what their plans shuffle."""

from datetime import date, datetime
from decimal import Decimal

import pytest

from skyfare.plans import marts, registry
from skyfare.sources import tables
from tests.conftest import rows

DAY = datetime(2000, 6, 5)
TABLES = {
    "nation": ("n_nationkey int, n_name string", [(1, "ALFA"), (2, "BETA"), (4, None)]),
    "supplier": ("s_suppkey bigint, s_nationkey int", [(10, 1), (11, 2), (12, None), (13, 4), (14, 9)]),
    "customer": ("c_custkey bigint, c_nationkey int", [(7, 1), (8, 2)]),
    "part": ("p_partkey bigint, p_type string, p_size int", [(1, "X", 3), (2, "Y", 4), (3, None, None)]),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp",
        [(1, 7, "F", 10.5, DAY), (2, 8, "O", 20.0, DAY), (3, 99, "F", 30.0, None), (4, None, None, None, DAY), (5, 7, "F", 1.0, DAY)],
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_returnflag string, l_shipdate timestamp",
        [
            (1, 2, 11, 2, 5.0, "A", DAY), (1, 1, 10, 1, 6.0, "B", DAY),
            # ties of line number and part go by supplier
            (2, 1, 11, 1, 1.0, "A", DAY), (2, 1, 10, 1, 2.0, "A", DAY), (2, 3, 12, 3, 2.0, "A", DAY),
            (3, 2, 13, 1, 1.0, None, None), (3, 9, 98, 2, 1.0, "A", DAY), (3, 1, 14, 3, 1.0, "A", DAY), (3, 1, 10, 4, 1.0, "A", DAY),
            (4, None, None, 1, 1.0, "A", DAY), (None, 1, 10, 1, 1.0, "A", DAY),
        ],
    ),
}
COLUMNS = ["leg_id", "flight_date", "starting_airport", "destination_airport", "base_fare", "total_travel_distance",
           "segments_airline_name", "segments_departure_airport_code"]
JUNE = date(2000, 6, 5)
EXPECTED = [
    (1, JUNE, "N01", "N02", Decimal("10.50"), 7, "ALFA||BETA", "N01||N01"),
    (2, JUNE, "N02", None, Decimal("20.00"), 6, "ALFA||BETA||", "N02||N01||N02"),
    (3, None, None, "N01", Decimal("30.00"), None, "||||||ALFA", "||N04||||N09"),
    (4, JUNE, None, None, None, None, "", ""),
]


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("trips"))
    for name, (schema, data) in TABLES.items():
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(params=[None, "-1", "20000"])
def threshold(spark, request):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    if request.param:
        spark.conf.set(key, request.param)
    yield request.param
    spark.conf.set(key, before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows(spark, sf, threshold):
    assert rows(tables.itineraries(spark, sf, COLUMNS)) == EXPECTED


def test_rows_of_few_legs(spark, sf, threshold):
    assert rows(tables.itineraries(spark, sf, COLUMNS, legs=[1, 2])) == [EXPECTED[0], EXPECTED[3]]


@pytest.mark.parametrize("threshold", ["20000"], indirect=True)
def test_lines_are_not_shuffled_for_small_tables(spark, sf, threshold):
    """The tables are smaller than the threshold, the product of suppliers and nations is not."""
    text = plan(tables.itineraries(spark, sf, COLUMNS))
    assert "hashpartitioning(l_suppkey" not in text and "hashpartitioning(l_orderkey" in text


@pytest.mark.parametrize("threshold", ["-1"], indirect=True)
def test_lists_are_not_shuffled_by_customer(spark, sf, threshold):
    text = plan(tables.itineraries(spark, sf, registry.BUILD_COLUMNS))
    assert text.index("SortMergeJoin [o_orderkey") < text.index("SortMergeJoin [o_custkey")


@pytest.mark.parametrize("name", ["route_request_valid", "route_layover_difference", "mart_build", "mart_update"])
def test_builds_join_the_legs_once(spark, sf, name, monkeypatch):
    read = []
    for call in ("build", "update"):
        f = getattr(marts, call)
        monkeypatch.setattr(marts, call, lambda s, df, *a, f=f, **k: read.append(df) or f(s, df, *a, **k))
    monkeypatch.setattr(registry, "_BUILT", {})
    registry.QUERIES[name](spark, sf).collect()
    assert read and not any("lineitem" in plan(df) for df in read)
