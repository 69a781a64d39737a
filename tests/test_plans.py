"""What the physical plans must and must not contain."""

import re

import pytest

from skyfare.plans.registry import QUERIES

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def no_broadcast(spark):
    """As on tables too large to broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield spark
    spark.conf.set(key, before)


@pytest.mark.parametrize("name", QUERIES)
def test_runs_on_built_ins_and_equi_joins(no_broadcast, name):
    text = plan(QUERIES[name](no_broadcast, DATA))
    for word in ("Python", "CartesianProduct", "NestedLoop", "Broadcast"):
        assert word not in text, word


def test_season_reaches_the_scan(spark):
    text = plan(QUERIES["avg_fare_season"](spark, DATA))
    assert "GreaterThanOrEqual(o_orderdate" in text or "o_orderdate" in re.search(
        r"DataFilters: \[([^\]]*)\].*orders", text
    ).group(1)
    assert "l_suppkey" not in text and "p_partkey" not in text


def test_scans_read_only_what_is_used(spark):
    text = plan(QUERIES["avg_cost_by_airport"](spark, DATA))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert sorted(schemas)[0] == "c_custkey:bigint,c_nationkey:int"
    assert "l_orderkey:bigint" in schemas


def test_extreme_shares_the_shuffle_with_its_rows(no_broadcast):
    df = QUERIES["dest_max_fare"](no_broadcast, DATA)
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_windows_over_everything_are_only_over_bucket_totals(no_broadcast):
    """Only aggregates and windows over sums of buckets use one partition."""
    for name in ("systematic_sample", "size_capped_extract", "size_capped_chunks", "route_popularity"):
        text = plan(QUERIES[name](no_broadcast, DATA))
        for single in text.split("Exchange SinglePartition")[1:]:
            assert "HashAggregate" in single.splitlines()[1] or "ObjectHashAggregate" in single.splitlines()[1], name


def test_summaries_read_the_facts_at_most_twice(spark):
    """The rollups are read instead; what makes them is one pass each."""
    for name in ("airport_layover_difference", "airport_map_points", "route_layover_difference", "route_line"):
        assert "lineitem" not in plan(QUERIES[name](spark, DATA)), name


def test_best_fares_are_picked_before_the_shuffle(no_broadcast):
    text = plan(QUERIES["carrier_max_fare_join"](no_broadcast, DATA))
    assert re.search(r"WindowGroupLimit.*Partial", text)
