import random
from collections import Counter, defaultdict
from datetime import date
from decimal import Decimal

from skyfare.operators import carriers
from tests.conftest import rows


def trip(airlines, fare, start="ATL", dest="BOS", **more):
    return {
        "segments_airline_name": airlines, "base_fare": fare,
        "starting_airport": start, "destination_airport": dest, **more,
    }


def test_shared_fare_does_not_leak_between_airlines(trips):
    df = trips([trip("A", 50), trip("A", 90), trip("B", 90), trip("B", 95)])
    expected = [("A", "ATL", "BOS", Decimal(90)), ("B", "ATL", "BOS", Decimal(95))]
    assert rows(carriers.top_fares(df, 1)) == expected
    assert [r[0] for r in rows(carriers.carrier_max_fare_join(df).select("airline_name"))] == [
        "A", "B"
    ]


def test_ties_go_to_the_first_route(trips):
    df = trips([trip("A", 90, "SFO", "LAX"), trip("A", 90, "DEN", "ORD"),
                trip("A", 90, "DEN", "JFK"), trip("A", 10, "ATL", "BOS")])
    assert rows(carriers.top_fares(df, 1)) == [("A", "DEN", "JFK", Decimal(90))]


def test_missing_fares_and_lists_drop_out(trips):
    df = trips([trip("A", None), trip(None, 5), trip("B", 1), trip("B", None)])
    assert rows(carriers.top_fares(df, 1)) == [("B", "ATL", "BOS", Decimal(1))]


def test_against_brute_force(trips):
    rng = random.Random(7)
    data = []
    for _ in range(400):
        airlines = "||".join(rng.choices("ABC", k=rng.randint(1, 4)))
        # one combination holds a third of the rows, most of them at one fare
        if rng.random() < 0.33:
            airlines, fare = "A||A", rng.choice([100, 100, 100, 20])
        else:
            fare = rng.randint(1, 30)
        data.append((airlines, fare, rng.choice("XYZ") * 3, rng.choice("UVW") * 3))
    df = trips([trip(*d) for d in data])

    groups = defaultdict(list)
    for airlines, fare, start, dest in data:
        groups[airlines].append((fare, start, dest))
    for legs in (1, 2, 3):
        expected = []
        for airlines, found in groups.items():
            if len(airlines.split("||")) == legs:
                fare, start, dest = min(found, key=lambda f: (-f[0], *f[1:]))
                expected.append((airlines, start, dest, Decimal(fare)))
        assert rows(carriers.top_fares(df, legs)) == sorted(expected, key=repr)

    top = {a: max(f[0] for f in found) for a, found in groups.items()}
    counts = Counter(d for d in data if d[1] == top[d[0]])
    expected = sorted((a, Decimal(f), s, d, n) for (a, f, s, d), n in counts.items())
    got = carriers.carrier_max_fare_join(df)
    order = ["airline_name", "base_fare", "starting_airport", "destination_airport"]
    assert sorted(tuple(r) for r in got.select(*order, "num_itineraries").collect()) == expected

    first = sorted(
        (a, s, d, Decimal(f)) for a, found in groups.items()
        for s, d, f in [min((s, d, f) for f, s, d in found)]
    )
    assert sorted(tuple(r) for r in carriers.carrier_dedupe(df).collect()) == first

    histogram = dict(carriers.legs_histogram(df).collect())
    assert sum(histogram.values()) == len(data)
    assert histogram == Counter(len(d[0].split("||")) for d in data)


def test_means_are_over_the_maxima(trips):
    df = trips([trip("A||B", 10), trip("A||B", 30), trip("B||A", 50), trip("A||A||A", 7),
                trip("A", 1000)])
    for tables in (carriers.carrier_maxima(df), carriers.top_fares(df, 2, 3)):
        assert rows(carriers.layover_mean_fares(tables)) == [(40.0, 7.0)]
    direct = carriers.carrier_maxima(trips([trip("A", 1)]))
    assert rows(carriers.layover_mean_fares(direct)) == [(None, None)]


def test_airline_counts_once_per_itinerary(trips):
    df = trips([trip("A||A||B", 30, flight_date="2022-05-01"),
                trip("B", 10, flight_date="2022-08-31"),
                trip("B", 99, flight_date="2022-09-01")])
    got = carriers.avg_fare_by_airline(df, date(2022, 5, 1), date(2022, 9, 1))
    assert rows(got) == [("A", 1, 30.0), ("B", 2, 20.0)]


def test_explode_segments(spark):
    df = spark.createDataFrame(
        [(1, "A||B", "100||x", "ATL||DEN"), (2, "C", "7", "SFO")],
        "leg_id bigint, segments_airline_name string, segments_distance string, "
        "segments_departure_airport_code string",
    )
    got = carriers.explode_segments(df)
    assert got.columns == ["leg_id", "segment_no", "departure_airport", "airline_name", "distance"]
    assert rows(got) == [(1, 1, "ATL", "A", 100), (1, 2, "DEN", "B", None), (2, 1, "SFO", "C", 7)]


def test_explode_segments_with_missing_lists(spark):
    df = spark.createDataFrame(
        [("a", "X", "1"), ("b", "X||Y", None), ("c", None, "3||4"), ("d", None, None)],
        "leg_id string, segments_airline_name string, segments_distance string",
    )
    got = rows(carriers.explode_segments(df).select("leg_id", "segment_no", "airline_name", "distance"))
    assert got == sorted([("a", 1, "X", 1), ("b", 1, "X", None), ("b", 2, "Y", None), ("c", 1, None, 3), ("c", 2, None, 4)], key=repr)
