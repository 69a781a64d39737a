import pytest

from skyfare.functions.constants import SOURCE_COLUMNS
from skyfare.operators import airports, carriers, fares
from skyfare.plans import marts, summary
from skyfare.sources import itineraries, tables
from tests.conftest import rows

DATA = "/root/testdata/sf0.001"
RUN = {"year": 2000, "months": [6, 7, 8], "route": ("N05", "N11")}


@pytest.fixture(scope="module")
def df(spark):
    return tables.itineraries(spark, DATA)


@pytest.fixture(scope="module")
def built(spark, df, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("marts"))
    return root, marts.build(spark, df, root, **RUN)


def direct(df):
    return {
        "average_flight_prices": fares.avg_fare_season(df, 2000, [6, 7, 8]),
        "route_average": fares.route_avg_fare(df, "N05", "N11"),
        "starting_flights": airports.airport_daily_flights_and_cost(df),
        "max_airport_base_fare": fares.dest_max_fare(df),
        "min_airport_base_fare": fares.dest_min_fare(df),
        "min_max_flights": fares.dest_fare_stats(df),
        "one_leg_flights": carriers.top_fares(df, 1),
        "two_leg_flights": carriers.top_fares(df, 2),
        "three_leg_flights": carriers.top_fares(df, 3),
        "travel_distance": airports.avg_distance_by_airport(df),
    }


def test_stored_tables_equal_the_queries(df, built):
    _, stored = built
    expected = direct(df)
    assert set(stored) == set(expected)
    for name, frame in expected.items():
        assert marts.differences(frame, stored[name]).count() == 0, name


def test_summary_from_stored_tables(df, built):
    _, stored = built
    departures = summary.departures_from_marts(
        stored["average_flight_prices"], stored["starting_flights"], stored["travel_distance"]
    )
    from_marts = summary.airport_summary(departures, stored["min_max_flights"])
    once = airports.airport_profile(df, 2000, [6, 7, 8])
    assert rows(from_marts.select(*once.columns)) == rows(once)


def test_from_csv_over_the_lake_to_tables(spark, df, built, tmp_path):
    _, expected = built
    names = {engine: source for source, (engine, _) in SOURCE_COLUMNS.items()}
    source = df.drop("num_legs")
    itineraries.write_csv(source.toDF(*[names[c] for c in source.columns]), f"{tmp_path}/csv")
    typed = itineraries.read_itineraries_csv(spark, f"{tmp_path}/csv")
    itineraries.write_lake(typed, f"{tmp_path}/lake")
    lake = itineraries.read_lake(spark, f"{tmp_path}/lake")
    assert rows(lake.groupBy("num_legs").count()) == rows(df.groupBy("num_legs").count())

    stored = marts.build(spark, lake, str(tmp_path), **RUN)
    for name, frame in expected.items():
        assert marts.differences(frame, stored[name]).count() == 0, name


def test_replacing_leaves_no_stale_rows(spark, df, tmp_path):
    root = str(tmp_path)
    marts.build(spark, df, root, **RUN)
    less = df.where("starting_airport = 'N05'")
    stored = marts.build(spark, less, root, **RUN)
    assert rows(stored["travel_distance"]) == rows(airports.avg_distance_by_airport(less))


def test_appending_again_adds_nothing(spark, df, built):
    root, stored = built
    before = {name: rows(frame) for name, frame in stored.items()}
    again = marts.build(spark, df, root, ignore_known=True, **RUN)
    assert {name: rows(frame) for name, frame in again.items()} == before


def test_first_build_makes_tables_that_keep_known_rows(spark, df, built, tmp_path):
    fresh = marts.build(spark, df, str(tmp_path / "new"), ignore_known=True, **RUN)
    assert {n: rows(f) for n, f in fresh.items()} == {n: rows(f) for n, f in built[1].items()}


def test_differences_name_the_side(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (3,)], "x int")
    assert rows(marts.differences(a, b)) == [(1, "missing"), (2, "missing"), (3, "extra")]
