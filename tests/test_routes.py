from decimal import Decimal

from skyfare.operators import routes, text
from tests.conftest import rows


def trip(start, dest, **more):
    return {"starting_airport": start, "destination_airport": dest, **more}


def test_counts_and_weights(trips):
    df = trips([trip("A", "B")] * 4 + [trip("B", "A")])
    paths = routes.flights_between(df)
    assert rows(paths) == [("A", "B", 4), ("B", "A", 1)]
    assert rows(routes.path_weight(paths)) == [("A", "B", 4, 1.0), ("B", "A", 1, 0.25)]


def test_duration_ignores_what_does_not_parse(trips):
    df = trips([trip("A", "B", travel_duration=d) for d in ("PT1H", "PT2H30M", "soon", None)])
    assert rows(routes.avg_duration_by_route(df)) == [("A", "B", 105.0)]


def test_nonstop_per_day_and_month(trips):
    df = trips(
        [trip("A", "B", is_nonstop=True, flight_date="2022-01-01")] * 3
        + [trip("A", "B", is_nonstop=True, flight_date="2022-01-02")]
        + [trip("A", "B", is_nonstop=False, flight_date="2022-01-03")]
    )
    assert rows(routes.avg_nonstop_per_route(df)) == [("A", "B", 2.0)]
    assert rows(routes.avg_nonstop_per_route(df, "month")) == [("A", "B", 4.0)]


def test_direct_against_layover(trips):
    df = trips([
        trip("A", "B", base_fare=10, segments_airline_name="X"),
        trip("A", "B", base_fare=20, segments_airline_name="X||Y"),
        trip("A", "B", base_fare=60, segments_airline_name="X||Y||X"),
        trip("A", "B", base_fare=70, segments_airline_name="X||Y||X||Y"),
        trip("A", "B", base_fare=999, segments_airline_name="X|||Y"),
        trip("A", "C", base_fare=5, segments_airline_name="X"),
    ])
    assert rows(routes.route_direct_vs_layover(df)) == [
        ("A", "B", 10.0, 50.0, 20.0, 60.0), ("A", "C", 5.0, None, None, None)
    ]


def test_popularity_by_season(trips):
    df = trips([
        trip("A", "B", base_fare=10, flight_date="2022-01-01"),
        trip("C", "B", base_fare=30, flight_date="2022-01-31"),
        trip("C", "B", base_fare=7, flight_date="2021-12-31"),
    ])
    assert rows(routes.popularity_by_season(df)) == [
        (2021, 12, "B", 1, 7.0), (2022, 1, "B", 2, 20.0)
    ]


def test_fare_lookup_takes_codes_as_data(trips):
    df = trips([trip("A", "B", base_fare=3), trip("A", "C", base_fare=4)])
    assert rows(routes.route_fare_lookup(df, "A", "B")) == [(Decimal(3),)]
    assert rows(routes.route_fare_lookup(df, "A' OR '1'='1", "B")) == []


def test_request_needs_both_airports(spark):
    requests = spark.createDataFrame(
        [("A", "B"), ("A", "X"), ("X", "B"), ("", "")],
        "starting_airport string, destination_airport string",
    )
    summary = spark.createDataFrame([("A",), ("B",)], "starting_airport string")
    assert rows(routes.route_request_valid(requests, summary)) == [("A", "B")]


def test_warm_ups(spark):
    numbers = spark.createDataFrame([(1,), (2,), (3,), (None,)], "n int")
    assert rows(text.squares_even(numbers, "n")) == [(4,)]
    lines = spark.createDataFrame(
        [(1, "spark rdd example"), (2, "sample example"), (3, "a  b"), (4, "")], "id int, t string"
    )
    assert [r[1] for r in text.tokenize(lines, "id", "t").collect()] == [
        "spark", "rdd", "example", "sample", "example", "a", "", "b", ""
    ]
