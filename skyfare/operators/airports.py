"""Traffic, cost and distance per starting airport."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfare.functions.constants import PREVIEW_ROWS
from skyfare.functions.expr import exact_avg, in_season, ratio


def period_column(period: str) -> Column:
    """The flight date, or the first day of its month."""
    if period == "day":
        return F.col("flight_date")
    return F.trunc("flight_date", period)


def flights_per_airport_day(df: DataFrame) -> DataFrame:
    return df.groupBy("starting_airport", "flight_date").agg(
        F.count("leg_id").alias("num_flights")
    )


def avg_flights(df: DataFrame, period: str = "day") -> DataFrame:
    """Average number of flights per period and starting airport, as a whole number.

    Periods without flights are not counted; flights without a date form one period.
    """
    name = f"average_flights_per_{period}"
    return (
        df.groupBy("starting_airport", period_column(period).alias("period"))
        .agg(F.count("leg_id").alias("n"))
        .groupBy("starting_airport")
        .agg(F.round(exact_avg("n")).cast("int").alias(name))
    )


def airport_daily_flights_and_cost(df: DataFrame) -> DataFrame:
    """Average flights per day and average fare per starting airport.

    The two results would meet in an inner join on the airport. Both fold out of one
    (airport, day) aggregate instead, so the table is read and shuffled once. As in
    the join, rows without an airport drop out.
    """
    daily = (
        df.where(F.col("starting_airport").isNotNull())
        .groupBy("starting_airport", "flight_date")
        .agg(
            F.count("leg_id").alias("n"),
            F.sum("base_fare").alias("fare"),
            F.count("base_fare").alias("fares"),
        )
    )
    return daily.groupBy("starting_airport").agg(
        F.round(exact_avg("n")).cast("int").alias("average_flights_per_day"),
        F.round(ratio(F.sum("fare"), F.sum("fares")), 2).alias("average_cost"),
    )


def avg_distance_by_airport(df: DataFrame) -> DataFrame:
    """Average travel distance per starting airport, longest first, airports without one last."""
    return (
        df.groupBy("starting_airport")
        .agg(exact_avg("total_travel_distance").alias("average_travel_distance"))
        .orderBy(F.col("average_travel_distance").desc(), "starting_airport")
    )


def top_distance_airports(df: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    """The first ``n`` rows of the distance ranking."""
    return avg_distance_by_airport(df).limit(n)


def airport_profile(df: DataFrame, year: int, months: list[int]) -> DataFrame:
    """Departure and arrival figures of every airport with a flight in the season.

    Each itinerary is counted at its start and at its destination, so season average,
    all-year cost, flights per day, distance and the extremes of inbound fares come from
    one pass: an (airport, day) aggregate for departures, one group per airport for
    arrivals, then one row per airport.
    """
    ends = df.selectExpr(
        """stack(2,
          starting_airport, true, flight_date, leg_id, base_fare, total_travel_distance, null,
          destination_airport, false, null, null, null, null, base_fare
        ) as (starting_airport, departs, flight_date, leg_id, fare, miles, inbound)"""
    )
    daily = (
        ends.where(F.col("starting_airport").isNotNull())
        .groupBy("starting_airport", "departs", "flight_date")
        .agg(
            F.count("leg_id").alias("n"),
            F.sum("fare").alias("fare"),
            F.count("fare").alias("fares"),
            F.sum("miles").alias("miles"),
            F.count("miles").alias("distances"),
            F.min("inbound").alias("min_inbound"),
            F.max("inbound").alias("max_inbound"),
        )
    )
    summer = in_season("flight_date", year, months)
    return (
        daily.groupBy("starting_airport")
        .agg(
            F.count_if(summer).alias("season_days"),
            F.bround(
                ratio(F.sum(F.when(summer, F.col("fare"))), F.sum(F.when(summer, F.col("fares")))),
                2,
            ).alias("average_base_fare"),
            F.round(exact_avg(F.when(F.col("departs"), F.col("n"))))
            .cast("int")
            .alias("average_flights_per_day"),
            F.round(ratio(F.sum("fare"), F.sum("fares")), 2).alias("average_cost"),
            ratio(F.sum("miles"), F.sum("distances")).alias("average_travel_distance"),
            F.min("min_inbound").alias("min_fare_inbound"),
            F.max("max_inbound").alias("max_fare_inbound"),
        )
        .where("season_days > 0")
        .drop("season_days")
    )
