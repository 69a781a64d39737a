from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from skyfare.operators import airports, fares, routes
from tests.conftest import rows


def fare(dest, value, **more):
    return {"destination_airport": dest, "base_fare": value, "starting_airport": "ATL", **more}


def test_documented_rows(trips):
    day = "2022-04-17"
    df = trips(
        [
            fare("BOS", "248.60", flight_date=day, seats_remaining=9, total_travel_distance=947),
            fare("BOS", "251.10", flight_date=day, seats_remaining=3, total_travel_distance=956),
            fare("BOS", "318.60", flight_date=day, seats_remaining=1, total_travel_distance=1462),
        ]
    )
    assert rows(fares.route_avg_fare(df, "ATL", "BOS")) == [(818.30 / 3,)]
    assert rows(fares.avg_fare_season(df, 2022, [4])) == [("ATL", 272.77, "272.77")]
    assert rows(fares.avg_fare_season(df, 2022, [6, 7, 8])) == []
    assert rows(airports.avg_distance_by_airport(df)) == [("ATL", 3365 / 3)]
    assert rows(routes.route_popularity(df)) == [(13 / 3, "ATL", "BOS", 1)]


def test_extremes_compare_numbers_not_text(trips):
    df = trips([fare("BOS", v) for v in ("99.5", "1000.25", "1000.25", "5000")])
    assert rows(fares.max_fare_by_dest(df)) == [("BOS", Decimal("5000.00"))]
    assert rows(fares.min_fare_by_dest(df)) == [("BOS", Decimal("99.50"))]


def test_all_tied_destinations_are_kept(trips):
    df = trips([fare("BOS", 500), fare("SFO", 500), fare("LAX", 20), fare("DEN", 20),
                fare("DEN", 30), fare("JFK", None)])
    assert rows(fares.dest_max_fare(df)) == [("BOS", Decimal(500)), ("SFO", Decimal(500))]
    assert rows(fares.dest_min_fare(df)) == [("DEN", Decimal(20)), ("LAX", Decimal(20))]


def test_null_destination_is_a_group(trips):
    got = dict(fares.max_fare_by_dest(trips([fare(None, 5), fare("BOS", None)])).collect())
    assert got == {None: Decimal(5), "BOS": None}


def test_empty_route_gives_one_null_row(trips):
    assert rows(fares.route_avg_fare(trips([fare("BOS", 5)]), "SFO", "LAX")) == [(None,)]


def test_stats_are_ordered_and_formatted(trips):
    df = trips([fare("BOS", 1000), fare("BOS", "1468.25"), fare("LAX", 7)])
    stats = fares.dest_fare_stats(df)
    assert stats.where("not min_base_fare <= average_base_fare").count() == 0
    assert stats.where("not average_base_fare <= max_base_fare").count() == 0
    texts = dict(stats.select("destination_airport", "average_base_fare_text").collect())
    assert texts == {"BOS": "1,234.12", "LAX": "7.00"}
    assert rows(fares.format_fare(df)) == [("BOS", 1234.12, "1,234.12"), ("LAX", 7.0, "7.00")]
    best = stats.agg(F.max("max_base_fare")).first()[0]
    assert {r[1] for r in fares.dest_max_fare(df).collect()} == {best}


def test_flights_per_day_rounds_half_up(trips):
    day = ["2022-01-01"] * 4 + ["2022-01-02"]
    df = trips([fare("BOS", 1, flight_date=d) for d in day])
    assert rows(airports.avg_flights(df)) == [("ATL", 3)]  # (4 + 1) / 2
    assert rows(airports.avg_flights(df, "month")) == [("ATL", 5)]


def test_missing_date_counts_as_one_day(trips):
    df = trips([fare("BOS", 1, flight_date="2022-01-01")] + [fare("BOS", 2)] * 5)
    assert rows(airports.avg_flights(df)) == [("ATL", 3)]
    per_day = {r[1]: r[2] for r in airports.flights_per_airport_day(df).collect()}
    assert per_day == {date(2022, 1, 1): 1, None: 5}


def test_missing_leg_id_is_not_counted(trips):
    df = trips([fare("BOS", 1, flight_date="2022-01-01", leg_id=None), fare("BOS", 1)])
    assert {r[2] for r in airports.flights_per_airport_day(df).collect()} == {0, 1}


def test_one_pass_equals_the_join(trips):
    df = trips(
        [fare("BOS", i * 1.37, starting_airport="SFO" if i % 3 else "LAX",
              flight_date=f"2022-01-0{1 + i % 4}") for i in range(40)]
        + [fare("BOS", 3, starting_airport=None), fare("BOS", None)]
    )
    joined = airports.avg_flights(df).join(fares.avg_cost_by_airport(df), "starting_airport")
    assert rows(airports.airport_daily_flights_and_cost(df)) == rows(joined)


def test_distance_ranking_puts_unknown_last(trips):
    df = trips([
        {"starting_airport": "ATL"},
        {"starting_airport": "BOS", "total_travel_distance": 5},
        {"starting_airport": "DEN", "total_travel_distance": 9},
        {"starting_airport": "DEN"},
    ])
    assert [tuple(r) for r in airports.avg_distance_by_airport(df).collect()] == [
        ("DEN", 9.0), ("BOS", 5.0), ("ATL", None)
    ]
    assert [r[0] for r in airports.top_distance_airports(df, 1).collect()] == ["DEN"]
