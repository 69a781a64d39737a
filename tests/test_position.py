import random

import pytest
from pyspark.sql import functions as F

from skyfare.functions.constants import EXTRACT_COLUMNS
from skyfare.operators import extract, position, routes
from tests.conftest import rows


@pytest.fixture(params=[1, 4, 40])
def ranges(request, spark):
    """One range, a few, and many of a few rows."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    yield request.param
    spark.conf.set("spark.sql.shuffle.partitions", before)


def keyed(spark, keys):
    data = [(k, "x" * (k % 13)) for k in keys]
    random.Random(1).shuffle(data)
    return spark.createDataFrame(data, "leg_id bigint, note string").repartition(4)


def keys():
    rng = random.Random(3)
    dense = set(range(200, 420))
    sparse = set(rng.sample(range(5_000_000_000), 50))
    return sorted(dense | sparse | {-5, -14, 0})


def test_positions(spark, ranges):
    df = keyed(spark, keys())
    placed = position.with_preceding(df, ["leg_id"], {"rows": F.lit(1)})
    got = dict(placed.select("leg_id", "rows_before").collect())
    assert got == {k: i for i, k in enumerate(keys())}


def test_equal_rows_are_dealt_to_several_ranges(spark):
    df = spark.range(4000).selectExpr("cast(null as string) as note", "7 as leg_id")
    placed = position.Positions(df, ["leg_id"], {"rows": F.lit(1)}, False)
    assert placed.totals().count() > 1
    got = sorted(r.rows_before for r in placed.rows(placed.totals()).collect())
    assert got == list(range(4000))


def test_text_ids_repeats_and_nulls(spark, ranges):
    rng = random.Random(8)
    ids = ["".join(rng.choice("0123456789abcdef") for _ in range(32)) for _ in range(60)]
    days = [None, "2022-04-17", "2022-04-18", "2022-05-01"]
    data = [(rng.choice(ids + [None]), rng.choice(days), rng.choice([1, 2, None])) for _ in range(300)]
    df = spark.createDataFrame(data, "leg_id string, flight_date string, n int").repartition(5)
    ordered = sorted(data, key=lambda r: tuple((x is not None, x) for x in (r[1], r[0], r[2])))
    for step in (1, 5, 7):
        got = extract.systematic_sample(df, step=step)
        assert rows(got) == sorted(ordered[::step], key=repr)
    assert rows(extract.size_capped_extract(df, 1500)) == sorted(capped(ordered, 1500, 1), key=repr)
    assert rows(extract.size_capped_chunks(df, 1500, 40)) == sorted(capped(ordered, 1500, 40), key=repr)


def capped(ordered, budget, chunk):
    taken, total = [], 0
    for at in range(0, len(ordered), chunk):
        if total > budget:
            break
        taken += ordered[at : at + chunk]
        total += sum(len(str(x).encode()) for r in ordered[at : at + chunk] for x in r if x is not None)
    return taken


@pytest.mark.parametrize("step", [1, 5, 7])
def test_systematic_sample(spark, ranges, step):
    df = keyed(spark, keys())
    for narrow in (None, df.select("leg_id")):
        got = extract.systematic_sample(df, ("leg_id",), step, narrow)
        assert sorted(r.leg_id for r in got.collect()) == keys()[::step]
        assert got.columns == ["leg_id", "note"]


def expected_prefix(budget, chunk):
    taken, total = [], 0
    ordered = keys()
    for at in range(0, len(ordered), chunk):
        if total > budget:
            break
        part = ordered[at : at + chunk]
        taken += part
        total += sum(len(str(k)) + k % 13 for k in part)
    return taken


@pytest.mark.parametrize("budget", [-1, 0, 40, 900, 10**9])
def test_size_cap(spark, ranges, budget):
    got = extract.size_capped_extract(keyed(spark, keys()), budget, ("leg_id",))
    assert sorted(r.leg_id for r in got.collect()) == expected_prefix(budget, 1)


@pytest.mark.parametrize("budget", [-1, 0, 300, 10**9])
def test_size_cap_in_chunks(spark, ranges, budget):
    got = extract.size_capped_chunks(keyed(spark, keys()), budget, 25, ("leg_id",), True)
    assert sorted(r.leg_id for r in got.collect()) == expected_prefix(budget, 25)


def test_popularity_rank(spark, ranges):
    rng = random.Random(5)
    data = [(f"S{i}", "D", rng.choice([1, 2, 2, 2, 5])) for i in range(60) for _ in range(3)]
    data += [("NONE", "D", None)]
    df = spark.createDataFrame(
        data, "starting_airport string, destination_airport string, seats_remaining int"
    )
    got = routes.route_popularity(df).collect()
    averages = {r.starting_airport: r.average_seats_remaining for r in got}
    for r in got:
        mine = averages[r.starting_airport]
        if mine is None:
            assert r.starting_airport == "NONE" and r.popularity_rank is None
        else:
            lower = sum(a is not None and a < mine for a in averages.values())
            assert r.popularity_rank == lower + 1
    assert len(got) == 61


def test_extract_columns_and_stray_index(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Unnamed: 0` int, leg_id int, other int")
    assert extract.drop_index_column(df).columns == ["leg_id", "other"]
    assert extract.drop_index_column(extract.drop_index_column(df)).columns == ["leg_id", "other"]
    rest = tuple(c for c in EXTRACT_COLUMNS if c != "leg_id")
    assert rows(extract.extract_columns(df, without=rest)) == [(2,)]
    with pytest.raises(ValueError, match="search_date"):
        extract.extract_columns(df)
