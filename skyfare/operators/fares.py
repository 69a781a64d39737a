"""Fare statistics. Each is one grouped pass with map-side partial aggregation.

Fares are decimals: extremes compare as numbers and sums are exact. Averages come
out as doubles.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfare.functions.expr import exact_avg, fare_text
from skyfare.operators.filters import on_route, season


def avg_fare_season(df: DataFrame, year: int, months: list[int]) -> DataFrame:
    """Average base fare per starting airport in a season, to the cent, and as display text."""
    return (
        season(df, year, months)
        .groupBy("starting_airport")
        .agg(exact_avg("base_fare").alias("fare"))
        .select(
            "starting_airport",
            F.bround("fare", 2).alias("average_base_fare"),
            fare_text("fare").alias("average_base_fare_text"),
        )
    )


def route_avg_fare(df: DataFrame, start: str, dest: str) -> DataFrame:
    """Average base fare of one route: always one row, NULL for an empty route."""
    return on_route(df, start, dest).agg(exact_avg("base_fare").alias("average_base_fare"))


def avg_cost_by_airport(df: DataFrame) -> DataFrame:
    return df.groupBy("starting_airport").agg(
        F.round(exact_avg("base_fare"), 2).alias("average_cost")
    )


def max_fare_by_dest(df: DataFrame) -> DataFrame:
    return df.groupBy("destination_airport").agg(F.max("base_fare").alias("max_base_fare"))


def min_fare_by_dest(df: DataFrame) -> DataFrame:
    return df.groupBy("destination_airport").agg(F.min("base_fare").alias("min_base_fare"))


def rows_at(df: DataFrame, column: str, extreme) -> DataFrame:
    """All rows where ``column`` equals its overall extreme, ties included.

    The extreme is a scalar subquery over the same small frame: no driver round
    trip, and the shuffle below is shared by both uses.
    """
    value: Column = df.agg(extreme(column).alias("value")).scalar()
    return df.where(F.col(column) == value)


def dest_max_fare(df: DataFrame) -> DataFrame:
    """Destinations that hold the highest base fare."""
    return rows_at(max_fare_by_dest(df), "max_base_fare", F.max)


def dest_min_fare(df: DataFrame) -> DataFrame:
    """Destinations that hold the lowest base fare."""
    return rows_at(min_fare_by_dest(df), "min_base_fare", F.min)


def dest_fare_stats(df: DataFrame) -> DataFrame:
    """Lowest, highest and average base fare per destination."""
    return (
        df.groupBy("destination_airport")
        .agg(
            F.min("base_fare").alias("min_base_fare"),
            F.max("base_fare").alias("max_base_fare"),
            exact_avg("base_fare").alias("fare"),
        )
        .select(
            "destination_airport",
            "min_base_fare",
            "max_base_fare",
            F.bround("fare", 2).alias("average_base_fare"),
            fare_text("fare").alias("average_base_fare_text"),
        )
    )


def format_fare(df: DataFrame) -> DataFrame:
    """Average base fare per destination as a number and as display text."""
    return dest_fare_stats(df).select(
        "destination_airport", "average_base_fare", "average_base_fare_text"
    )
