import itertools
import re
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from skyfare.functions import expr
from skyfare.functions.constants import THREE_LEGS, TWO_LEGS
from skyfare.operators import filters
from tests.conftest import rows

LISTS = ["A", "A|B", "A||B", "A||B||C", "A||||B", "A|||B", "A|B||C", "A||B||C||D", "", None]


@pytest.fixture(scope="module")
def lists(spark):
    return spark.createDataFrame([(s,) for s in LISTS], "segments_airline_name string")


def test_leg_count(lists):
    got = dict(lists.select("*", expr.leg_count("segments_airline_name")).collect())
    assert got == {
        "A": 1, "A|B": 1, "A||B": 2, "A||B||C": 3, "A||||B": 3, "A|||B": None,
        "A|B||C": None, "A||B||C||D": 4, "": 1, None: None,
    }


def test_leg_filters_agree_with_leg_count(lists):
    counted = lists.withColumn("n", expr.leg_count("segments_airline_name"))
    for legs in (1, 2, 3):
        expected = rows(counted.where(F.col("n") == legs).select("segments_airline_name"))
        assert rows(filters.with_legs(lists, legs)) == expected


def test_leg_filters_against_the_patterns(spark):
    texts = ["".join(t) for n in range(9) for t in itertools.product("A|", repeat=n)]
    df = spark.createDataFrame([(t,) for t in texts], "segments_airline_name string")
    expected = {
        1: [t for t in texts if "||" not in t],
        2: [t for t in texts if re.fullmatch(TWO_LEGS, t)],
        3: [t for t in texts if re.fullmatch(THREE_LEGS, t)],
    }
    counts = dict(df.select("*", expr.leg_count("segments_airline_name")).collect())
    for legs, kept in expected.items():
        assert rows(filters.with_legs(df, legs)) == sorted((t,) for t in kept)
        assert sorted(t for t, n in counts.items() if n == legs) == sorted(kept)


def test_duration_minutes(spark):
    texts = {
        "PT2H29M": 149, "PT45M": 45, "PT3H": 180, "P1DT2H5M": 1565, "P2D": 2880, "PT0H5M": 5,
        "P": None, "PT": None, "P1DT": None, "2H": None, "PT5M2H": None, "PT2H29M ": None,
        "": None, "PT100000M": 100000, "P12345D": 12345 * 1440, "P1DT" + "9" * 30 + "H": None,
        "xx": None, "PTHM": None, "P T2H": None, None: None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "d string")
    assert dict(df.select("d", expr.duration_minutes("d")).collect()) == texts


def test_season_is_a_range_with_gaps_checked(spark):
    days = ["2022-05-31", "2022-06-01", "2022-07-15", "2022-08-31", "2022-09-01", "2021-06-05"]
    df = spark.createDataFrame([(d,) for d in [*days, None]], "d string").select(
        F.col("d").cast("date").alias("flight_date")
    )
    summer = filters.season(df, 2022, [6, 7, 8])
    assert [str(r[0]) for r in rows(summer)] == days[1:4]
    assert [str(r[0]) for r in rows(filters.season(df, 2022, [8, 6]))] == [days[1], days[3]]
    assert filters.season(df, 2022, [11, 12]).count() == 0
    assert expr.month_start(2022, 13) == date(2023, 1, 1)


def test_fare_text_is_half_even_with_commas(spark):
    df = spark.createDataFrame([(1234.125,), (0.5,), (None,)], "x double")
    assert [r[0] for r in df.select(expr.fare_text("x")).collect()] == ["1,234.12", "0.50", None]


def test_exact_avg_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "x decimal(18,2)")
    assert df.agg(expr.exact_avg("x")).first()[0] is None
    assert df.where("false").agg(expr.exact_avg("x")).first()[0] is None


def test_exact_avg(spark):
    df = spark.createDataFrame([(Decimal("0.10"),), (Decimal("0.20"),), (None,)], "x decimal(18,2)")
    assert df.agg(expr.exact_avg("x")).first()[0] == 0.15


def test_layover_label_of_null_is_the_second(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (-1.0,), (None,)], "x double")
    assert [r[0] for r in df.select(expr.layover_label("x")).collect()] == [
        "Layover Cheaper", "Layover Cheaper",
        "Layovers More Expensive", "Layovers More Expensive",
    ]


def test_plain_text(spark):
    df = spark.createDataFrame([(12345678.5,), (None,)], "x double")
    assert [r[0] for r in df.select(expr.plain_text("x")).collect()] == ["12345678.50", "nan"]


def test_airport_list_default(spark):
    df = spark.createDataFrame([("ATL",), ("SFO",), ("XXX",), (None,)], "iata string")
    assert rows(filters.airports_in(df)) == [("ATL",), ("SFO",)]
    assert rows(filters.airports_in(df, ["XXX"])) == [("XXX",)]


def test_cast_flight_date_keeps_bad_rows_as_null(spark):
    df = spark.createDataFrame([("2022-04-17",), ("xx",), (None,)], "flight_date string")
    got = [r[0] for r in filters.cast_flight_date(df).collect()]
    assert got == [date(2022, 4, 17), None, None]
