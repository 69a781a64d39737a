"""The airport and route summaries behind the map."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfare.functions.constants import AIRPORT_HOVER, LINE_BREAK, MISSING_TEXT, ROUTE_HOVER
from skyfare.functions.expr import layover_label, leg_count, plain_text
from skyfare.operators.routes import ROUTE, route_request_valid


def departures_from_marts(
    avg_fares: DataFrame, starting_flights: DataFrame, travel_distance: DataFrame
) -> DataFrame:
    """Departure side of the summary by left joins of three stored results.

    Flights without a starting airport are in no airport's summary.
    """
    return (
        avg_fares.drop("average_base_fare_text")
        .where(F.col("starting_airport").isNotNull())
        .join(starting_flights, "starting_airport", "left")
        .join(travel_distance, "starting_airport", "left")
    )


def airport_summary(departures: DataFrame, arrivals: DataFrame) -> DataFrame:
    """One row per airport with a season average, by left joins of stored results.

    The extremes are those of flights into the airport, hence ``inbound``. The same
    frame comes straight from itineraries in ``airports.airport_profile``.
    """
    inbound = (
        arrivals.drop("average_base_fare", "average_base_fare_text")
        .withColumnRenamed("destination_airport", "starting_airport")
        .withColumnRenamed("min_base_fare", "min_fare_inbound")
        .withColumnRenamed("max_base_fare", "max_fare_inbound")
    )
    return departures.join(inbound, "starting_airport", "left")


def airport_layover_difference(summary: DataFrame, means: DataFrame) -> DataFrame:
    """How far each airport's average is from the mean layover fares, with a label.

    ``means`` has one row; it enters as one scalar subquery. A missing mean gives no
    difference and the second label.
    """
    mean = means.agg(
        F.struct(F.max("one_layover_mean").alias("one"), F.max("two_layover_mean").alias("two"))
    ).scalar()

    def difference(layovers: str) -> Column:
        return F.bround(F.col("average_base_fare") - F.col(f"mean.{layovers}"), 2)

    return (
        summary.withColumn("mean", mean)
        .withColumns(
            {
                "one_layover_difference": difference("one"),
                "two_layover_difference": difference("two"),
            }
        )
        .withColumns(
            {
                "one_layover_label": layover_label("one_layover_difference"),
                "two_layover_label": layover_label("two_layover_difference"),
                "one_layover_difference": F.abs("one_layover_difference"),
                "two_layover_difference": F.abs("two_layover_difference"),
            }
        )
        .drop("mean")
    )


def as_text(df: DataFrame) -> DataFrame:
    """Every column as display text: fractions to the cent, missing values spelled out."""

    def shown(name: str, kind: str) -> Column:
        if kind == "double" or kind.startswith("decimal"):
            return plain_text(name).alias(name)
        return F.coalesce(F.col(name).cast("string"), F.lit(MISSING_TEXT)).alias(name)

    return df.select([shown(name, kind) for name, kind in df.dtypes])


def airport_map_points(layovers: DataFrame, airports: DataFrame) -> DataFrame:
    """Map markers: code, position and hover text, by code.

    Text and position meet on the code. An airport without a summary keeps its
    marker and has no text.
    """
    texts = as_text(layovers).select(
        F.col("starting_airport").alias("iata"),
        F.format_string(
            LINE_BREAK.join(AIRPORT_HOVER),
            "starting_airport",
            "average_base_fare",
            "average_cost",
            "average_flights_per_day",
            "average_travel_distance",
            "min_fare_inbound",
            "max_fare_inbound",
            "one_layover_difference",
            "one_layover_label",
            "two_layover_difference",
            "two_layover_label",
        ).alias("hover_text"),
    )
    return (
        airports.join(texts, "iata", "left")
        .select("iata", F.col("long").alias("lon"), "lat", "hover_text")
        .orderBy("iata")
    )


def route_layover_difference(
    requests: DataFrame, layovers: DataFrame, top_fares: DataFrame
) -> DataFrame:
    """For each valid requested pair, the differences of its starting airport and the
    dearest fares found on the pair itself.

    ``top_fares`` are the two- and three-leg results.
    """
    valid = route_request_valid(requests, layovers)
    legs, fare = leg_count("airline_name"), F.col("base_fare")
    pair = top_fares.groupBy(*ROUTE).agg(
        F.count_if(legs == 2).alias("one_layover_fares"),
        F.max(F.when(legs == 2, fare)).alias("one_layover_top_fare"),
        F.count_if(legs == 3).alias("two_layover_fares"),
        F.max(F.when(legs == 3, fare)).alias("two_layover_top_fare"),
    )
    start = layovers.select("starting_airport", "one_layover_difference", "two_layover_difference")
    return (
        valid.join(start, "starting_airport")
        .join(pair, ROUTE, "left")
        .select(
            *ROUTE,
            "one_layover_difference",
            "two_layover_difference",
            F.coalesce("one_layover_fares", F.lit(0)).alias("one_layover_fares"),
            "one_layover_top_fare",
            F.coalesce("two_layover_fares", F.lit(0)).alias("two_layover_fares"),
            "two_layover_top_fare",
        )
    )


def with_endpoints(routes: DataFrame, airports: DataFrame) -> DataFrame:
    """Positions of both ends of each route; a route to an unknown airport keeps its row."""
    start = airports.select(
        F.col("iata").alias("starting_airport"),
        F.col("long").alias("start_lon"),
        F.col("lat").alias("start_lat"),
    )
    end = airports.select(
        F.col("iata").alias("destination_airport"),
        F.col("long").alias("end_lon"),
        F.col("lat").alias("end_lat"),
    )
    located = routes.join(start, "starting_airport", "left").join(
        end, "destination_airport", "left"
    )
    return located.select(*routes.columns, "start_lon", "start_lat", "end_lon", "end_lat")


def route_line(requests: DataFrame, layovers: DataFrame, airports: DataFrame) -> DataFrame:
    """Line and hover text for each valid requested pair."""
    start = layovers.select("starting_airport", "one_layover_difference", "two_layover_difference")
    pairs = route_request_valid(requests, layovers).join(start, "starting_airport")
    text = F.format_string(
        LINE_BREAK.join(ROUTE_HOVER),
        *ROUTE,
        plain_text("one_layover_difference"),
        plain_text("two_layover_difference"),
    )
    return with_endpoints(pairs, airports).select(
        *ROUTE, "start_lon", "start_lat", "end_lon", "end_lat", text.alias("hover_text")
    )
