"""Row filters over itineraries."""

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfare.functions.constants import (
    MAP_AIRPORTS,
    SEGMENT_SEPARATOR,
    THREE_LEGS,
    TWO_LEGS,
)
from skyfare.functions.expr import in_date_range, in_season, month_start


def cast_flight_date(df: DataFrame) -> DataFrame:
    """Text dates to dates; a text that is no date gives NULL instead of failing the job."""
    return df.withColumn("flight_date", F.col("flight_date").try_cast("date"))


def departing(df: DataFrame, first: date, end: date) -> DataFrame:
    """Flights in ``[first, end)``. Rows without a date drop out.

    The range reaches the scan as it is; on a table partitioned by month it is
    repeated on the partition column, so other months are not even listed.
    """
    keep = in_date_range("flight_date", first, end)
    if "flight_month" in df.columns:
        last = end - timedelta(days=1)
        months = F.col("flight_month").between(
            first.year * 100 + first.month, last.year * 100 + last.month
        )
        keep = months & keep
    return df.where(keep)


def season(df: DataFrame, year: int, months: list[int]) -> DataFrame:
    """Flights of some months of one year."""
    first, last = min(months), max(months)
    span = departing(df, month_start(year, first), month_start(year, last + 1))
    return span.where(in_season("flight_date", year, months))


def on_route(df: DataFrame, start: str, dest: str) -> DataFrame:
    return df.where((F.col("starting_airport") == start) & (F.col("destination_airport") == dest))


def is_one_leg() -> Column:
    return ~F.col("segments_airline_name").contains(SEGMENT_SEPARATOR)


def is_two_legs() -> Column:
    return F.col("segments_airline_name").rlike(TWO_LEGS)


def is_three_legs() -> Column:
    return F.col("segments_airline_name").rlike(THREE_LEGS)


LEG_TESTS = {1: is_one_leg, 2: is_two_legs, 3: is_three_legs}


def with_legs(df: DataFrame, legs: int) -> DataFrame:
    """Itineraries of one, two or three legs. Malformed and missing lists drop out."""
    return df.where(LEG_TESTS[legs]())


def airports_in(airports: DataFrame, codes: list[str] | None = None) -> DataFrame:
    """Airport rows whose code is in a fixed list."""
    return airports.where(F.col("iata").isin(MAP_AIRPORTS if codes is None else codes))
