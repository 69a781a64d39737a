"""Rankings by period, overlapping periods, and times of segments."""

import random
import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from skyfare.operators import periods, segments
from tests.conftest import rows


def test_period_starts(spark):
    days = [date(2021, 12, 31), date(2022, 1, 1), date(2022, 2, 28), date(2022, 3, 1), date(2022, 5, 31), date(2022, 11, 30), date(2024, 2, 29), None]
    df = spark.createDataFrame([(d,) for d in days], "flight_date date")
    got = df.select(*[periods.period_start(p).alias(p) for p in ("month", "quarter", "season", "year")]).collect()
    assert [r.season for r in got] == [date(2021, 12, 1), date(2021, 12, 1), date(2021, 12, 1), date(2022, 3, 1), date(2022, 3, 1), date(2022, 9, 1), date(2023, 12, 1), None]
    assert [r.month for r in got[:3]] == [date(2021, 12, 1), date(2022, 1, 1), date(2022, 2, 1)]
    assert got[4].quarter == date(2022, 4, 1) and got[6].year == date(2024, 1, 1)
    with pytest.raises(ValueError, match="fortnight"):
        periods.period_start("fortnight")


@pytest.mark.parametrize("k", [1, 2, 5])
def test_top_keeps_all_ties(spark, k):
    r = random.Random(k)
    data = [(p, f"D{i}", r.choice([None, 1, 2, 3, 4])) for p in ("a", "b", None) for i in range(12)] + [("alone", "D", None)]
    df = spark.createDataFrame(data, "period_start string, destination string, n int").repartition(4)
    got = rows(periods.top_per_period(df, "n", k))
    expected = []
    for p, d, n in data:
        place = 1 + sum(q == p and m is not None and n is not None and m > n for q, _, m in data)
        if n is not None and place <= k:
            expected.append((p, d, n, place))
    assert got == sorted(expected, key=repr)


def test_top_is_limited_before_the_shuffle(spark):
    df = spark.range(10).selectExpr("id % 2 as period_start", "id as n")
    plan = periods.top_per_period(df, "n", 3)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"WindowGroupLimit \[period_start[^]]*\].*, 3, Partial", plan) and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_every_period_over_gaps(spark, trips):
    r = random.Random(4)
    data = []
    for _ in range(60):
        day = date(r.choice([2019, 2020, 2022]), r.choice([1, 2, 7, 12]), r.randint(1, 28))
        data.append({"flight_date": r.choice([day, day, day, None]), "base_fare": r.choice([None, 10, 20.5, 33]), "segments_airline_name": r.choice(["A", "A||B", "B||A||B", "C", None])})
    data.append({"flight_date": date(2000, 1, 1), "base_fare": None, "segments_airline_name": "D"})
    got = {(r.airline_name, r.period_start): (r.period_end, r.num_itineraries, r.average_base_fare) for r in periods.avg_fare_by_airline_rolling(periods.airline_months(trips(data)), 4).collect()}
    expected = {}
    for airline in "ABCD":
        for first in range(1999 * 12, 2024 * 12):
            inside = [d for d in data if d["flight_date"] and airline in (d["segments_airline_name"] or "").split("||") and first <= d["flight_date"].year * 12 + d["flight_date"].month - 1 < first + 4]
            fares = [d["base_fare"] for d in inside if d["base_fare"] is not None]
            if inside:
                end = first + 4
                expected[airline, date(first // 12, first % 12 + 1, 1)] = (date(end // 12, end % 12 + 1, 1), len(inside), sum(fares) / len(fares) if fares else None)
    assert got == {k: (e, n, pytest.approx(a) if a is not None else None) for k, (e, n, a) in expected.items()}
    assert periods.avg_fare_by_airline_rolling(periods.airline_months(trips([]))).collect() == []


def test_times_with_offsets(spark):
    texts = {
        "2022-04-17T12:57:00.000-04:00": (datetime(2022, 4, 17, 12, 57), -240, datetime(2022, 4, 17, 16, 57)),
        "2022-03-13T01:30:00+0530": (datetime(2022, 3, 13, 1, 30), 330, datetime(2022, 3, 12, 20, 0)),
        "2022-03-27 02:30:00Z": (datetime(2022, 3, 27, 2, 30), 0, datetime(2022, 3, 27, 2, 30)),
        "2022-03-27T02:30": (datetime(2022, 3, 27, 2, 30), None, datetime(2022, 3, 27, 2, 30)),
        "2022-03-27": (None, None, None), "soon": (None, None, None), "": (None, None, None), None: (None, None, None),
        "2022-02-30T10:00:00Z": (None, 0, None),
    }
    before = spark.conf.get("spark.sql.session.timeZone")
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", segments.time_at(F.col("t")).alias("at"))
            got = {r.t: (r.at.local, r.at.offset_minutes, r.at.utc, r.at.epoch) for r in df.collect()}
        finally:
            spark.conf.set("spark.sql.session.timeZone", before)
        for t, (local, ahead, utc) in texts.items():
            epoch = None if utc is None else int((utc - datetime(1970, 1, 1)).total_seconds())
            assert got[t] == (local, ahead, utc, epoch), (zone, t)


def test_layovers_between_segments(spark):
    schema = "leg_id int, segments_departure_time_raw string, segments_arrival_time_raw string"
    data = [
        (1, "2022-04-17T22:00:00-04:00||2022-04-18T06:00:00-05:00||", "2022-04-17T23:30:00-05:00||2022-04-18T07:00:00-05:00||2022-04-18T09:00:00Z"),
        (2, "2022-04-17T22:00:00Z", "2022-04-17T23:30:00Z"),
        (3, None, "2022-04-17T23:30:00Z||2022-04-17T23:30:00Z"),
        (4, None, None),
        (5, "2022-04-17T10:00:00Z||2022-04-17T10:30:45Z", "2022-04-17T10:30:00Z"),
    ]
    df = segments.segment_times(spark.createDataFrame(data, schema))
    got = {(r.leg_id, r.segment_no): (r.layover_minutes, r.overnight_stop) for r in df.collect()}
    assert got == {
        (1, 1): (390, True), (1, 2): (None, None), (1, 3): (None, None), (2, 1): (None, None),
        (3, 1): (None, None), (3, 2): (None, None), (5, 1): (0, False), (5, 2): (None, None),
    }
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert rows(segments.layovers(df)) == [(1, 1, 390, 390, 1), (2, 0, None, None, 0), (3, 0, None, None, 0), (5, 1, 0, 0, 0)]
