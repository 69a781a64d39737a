from skyfare.operators import airports, carriers, fares
from skyfare.plans import summary
from tests.conftest import rows


def trip(start, dest, fare, airlines="X", day="2022-06-01", miles=None):
    return {
        "starting_airport": start, "destination_airport": dest, "base_fare": fare,
        "segments_airline_name": airlines, "flight_date": day, "total_travel_distance": miles,
    }


TRIPS = [
    trip("A", "B", 100, miles=10),
    trip("A", "B", 50, day="2022-01-01", miles=21),
    trip("B", "A", 30, "X||Y"),
    trip("B", "A", 90, "X||Y||X"),
    trip("C", "A", 5, day="2021-06-01"),
    trip("D", "A", None),
    trip(None, "A", 1),
]


def frames(trips, data):
    df = trips(data)
    base = airports.airport_profile(df, 2022, [6, 7, 8])
    means = carriers.layover_mean_fares(carriers.carrier_maxima(df))
    return df, base, summary.airport_layover_difference(base, means)


def test_summary_keeps_airports_with_a_season_flight(trips):
    _, base, _ = frames(trips, TRIPS)
    got = {r.starting_airport: r.asDict() for r in base.collect()}
    assert sorted(got) == ["A", "B", "D"]
    a = got["A"]
    assert (a["average_base_fare"], a["average_cost"], a["average_flights_per_day"]) == (100, 75, 1)
    assert a["average_travel_distance"] == 15.5
    assert (a["min_fare_inbound"], a["max_fare_inbound"]) == (1, 90)
    assert got["D"]["average_base_fare"] is None
    assert got["D"]["max_fare_inbound"] is None


def test_one_pass_equals_the_joined_results(trips):
    df, once, _ = frames(trips, TRIPS)
    departures = summary.departures_from_marts(
        fares.avg_fare_season(df, 2022, [6, 7, 8]),
        airports.airport_daily_flights_and_cost(df),
        airports.avg_distance_by_airport(df),
    )
    joined = summary.airport_summary(departures, fares.dest_fare_stats(df))
    assert rows(once) == rows(joined.select(*once.columns))


def test_layover_differences(trips):
    _, _, layovers = frames(trips, TRIPS)
    got = {r.starting_airport: r for r in layovers.collect()}
    assert (got["A"].one_layover_difference, got["A"].two_layover_difference) == (70.0, 10.0)
    assert got["A"].two_layover_label == "Layover Cheaper"
    assert (got["B"].one_layover_difference, got["B"].two_layover_difference) == (30.0, 30.0)
    assert got["B"].two_layover_label == "Layovers More Expensive"
    assert got["D"].one_layover_difference is None
    assert got["D"].one_layover_label == "Layovers More Expensive"


def test_no_layovers_at_all(trips):
    _, _, layovers = frames(trips, [trip("A", "B", 10)])
    row = layovers.first()
    assert row.one_layover_difference is None
    assert row.one_layover_label == row.two_layover_label == "Layovers More Expensive"


AIRPORTS = [("B", 2.0, 20.0), ("A", 1.0, 10.0), ("Z", 9.0, 90.0)]


def located(spark):
    return spark.createDataFrame(AIRPORTS, "iata string, long double, lat double")


def test_map_text_belongs_to_its_airport(spark, trips):
    _, _, layovers = frames(trips, TRIPS)
    points = summary.airport_map_points(layovers, located(spark)).collect()
    assert [(p.iata, p.lon, p.lat) for p in points] == [
        ("A", 1.0, 10.0), ("B", 2.0, 20.0), ("Z", 9.0, 90.0)
    ]
    assert points[0].hover_text.split("<br>") == [
        "Airport: A",
        "Avg Basefare: $100.00",
        "Avg Cost of Flight: $75.00",
        "Avg Amount of Flights per Day: 1",
        "Avg Travel Distance: 15.50 Miles",
        "Min Basefare: $1.00",
        "Max Basefare: $90.00",
        "Avg Layover Basefare Difference: $70.00, Layover Cheaper",
        "Avg 2-Layover Basefare Difference: $10.00, Layover Cheaper",
    ]
    assert "Avg Travel Distance: nan Miles" in points[1].hover_text
    assert points[2].hover_text is None


def test_requested_routes(spark, trips):
    more = [trip("A", "B", 40, "X||Z"), trip("A", "B", 60, "Z||Z")]
    df, _, layovers = frames(trips, TRIPS + more)
    requests = spark.createDataFrame(
        [("A", "B"), ("B", "A"), ("A", "Q"), ("C", "A")],
        "starting_airport string, destination_airport string",
    )
    top = carriers.top_fares(df, 2, 3)
    got = {
        (r.starting_airport, r.destination_airport): r
        for r in summary.route_layover_difference(requests, layovers, top).collect()
    }
    assert sorted(got) == [("A", "B"), ("B", "A")]
    a, b = got["A", "B"], got["B", "A"]
    # the differences are those of the start; fares are those of the pair
    starts = {r.starting_airport: r.one_layover_difference for r in layovers.collect()}
    assert a.one_layover_difference == starts["A"] and b.one_layover_difference == starts["B"]
    assert (a.one_layover_fares, a.one_layover_top_fare, a.two_layover_fares) == (2, 60, 0)
    assert a.two_layover_top_fare is None
    assert (b.one_layover_fares, b.one_layover_top_fare, b.two_layover_top_fare) == (1, 30, 90)

    lines = {r.starting_airport: r for r in
             summary.route_line(requests, layovers, located(spark)).collect()}
    line = lines["B"]
    assert (line.start_lon, line.start_lat, line.end_lon, line.end_lat) == (2, 20, 1, 10)
    assert line.hover_text == (
        "Average Layover Basefare Difference Between B and A: "
        f"${b.one_layover_difference:.2f}<br>"
        "Average 2-Layover Basefare Difference Between B and A: "
        f"${b.two_layover_difference:.2f}"
    )
