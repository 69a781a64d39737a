"""Questions about airport pairs."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfare.functions.expr import duration_minutes, exact_avg
from skyfare.operators.airports import period_column
from skyfare.operators.filters import on_route
from skyfare.operators.position import with_preceding

ROUTE = ["starting_airport", "destination_airport"]


def flights_between(df: DataFrame) -> DataFrame:
    return df.groupBy(*ROUTE).agg(F.count("*").alias("cnt"))


def avg_duration_by_route(df: DataFrame) -> DataFrame:
    """Average travel time in minutes; durations that do not parse are left out."""
    return (
        df.withColumn("minutes", duration_minutes("travel_duration"))
        .groupBy(*ROUTE)
        .agg(exact_avg("minutes").alias("average_minutes"))
    )


def route_popularity(df: DataFrame) -> DataFrame:
    """Routes ranked by remaining seats: the fewer on average, the more popular.

    The rank is one plus the number of routes with a smaller average, counted over the
    distinct averages. Routes without seat information have no rank.
    """
    seats = F.col("average_seats_remaining")
    routes = df.groupBy(*ROUTE).agg(exact_avg("seats_remaining").alias("average_seats_remaining"))
    groups = (
        routes.where(seats.isNotNull())
        .groupBy("average_seats_remaining")
        .agg(F.count("*").alias("routes"))
    )
    ranks = with_preceding(groups, ["average_seats_remaining"], {"routes": F.col("routes")}, True)
    return routes.join(
        ranks.select(
            "average_seats_remaining", (F.col("routes_before") + 1).alias("popularity_rank")
        ),
        "average_seats_remaining",
        "left",
    )


def avg_nonstop_per_route(df: DataFrame, period: str = "day") -> DataFrame:
    """Average number of nonstop flights per period with any, by route."""
    return (
        df.where("is_nonstop")
        .groupBy(*ROUTE, period_column(period).alias("period"))
        .agg(F.count("leg_id").alias("n"))
        .groupBy(*ROUTE)
        .agg(exact_avg("n").alias(f"average_nonstop_per_{period}"))
    )


def popularity_by_season(df: DataFrame) -> DataFrame:
    """Flights into each destination and their average fare, by year and month."""
    return df.groupBy(
        F.year("flight_date").alias("year"),
        F.month("flight_date").alias("month"),
        "destination_airport",
    ).agg(
        F.count("*").alias("num_flights"),
        exact_avg("base_fare").alias("average_base_fare"),
    )


def route_direct_vs_layover(df: DataFrame) -> DataFrame:
    """Average fare of direct flights and of flights with layovers, by route."""
    legs, fare = F.col("num_legs"), F.col("base_fare")
    return df.groupBy(*ROUTE).agg(
        exact_avg(F.when(legs == 1, fare)).alias("direct_average"),
        exact_avg(F.when(legs > 1, fare)).alias("layover_average"),
        exact_avg(F.when(legs == 2, fare)).alias("one_layover_average"),
        exact_avg(F.when(legs == 3, fare)).alias("two_layover_average"),
    )


def path_weight(paths: DataFrame) -> DataFrame:
    """Each path's count as a share of the largest count."""
    largest = paths.agg(F.max("cnt").alias("m")).scalar()
    return paths.withColumn("weight", F.col("cnt").cast("double") / largest)


def route_fare_lookup(top: DataFrame, start: str, dest: str) -> DataFrame:
    """Fares of one pair in a table of dearest fares.

    The codes are literals, so the filter reaches parquet row groups or a database.
    """
    return on_route(top, start, dest).select("base_fare")


def route_request_valid(requests: DataFrame, summary: DataFrame) -> DataFrame:
    """Requested pairs whose two airports are both in the summary."""
    known = summary.select("starting_airport")
    valid = requests.join(known, "starting_airport", "left_semi")
    known = known.withColumnRenamed("starting_airport", "destination_airport")
    return valid.join(known, "destination_airport", "left_semi").select(*requests.columns)
