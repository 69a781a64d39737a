"""Questions about airlines and leg counts."""

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfare.functions.constants import SEGMENT_COLUMNS
from skyfare.functions.expr import exact_avg, leg_count, segment_list
from skyfare.operators.filters import LEG_TESTS, departing


def _airline() -> Column:
    return F.col("segments_airline_name").alias("airline_name")


def first_route(cells: DataFrame, *order) -> DataFrame:
    """Per airline, the cell that comes first by ``order``.

    ``cells`` holds one row per airline and route, so even an airline with a third of
    all itineraries has no more rows here than there are routes; partial aggregates
    shrink them again before the shuffle.
    """
    first = F.min(F.struct(*order, "starting_airport", "destination_airport", "base_fare"))
    return (
        cells.groupBy("airline_name")
        .agg(first.alias("f"))
        .select("airline_name", "f.starting_airport", "f.destination_airport", "f.base_fare")
    )


def carrier_routes(df: DataFrame, legs: list[int], *by: str) -> DataFrame:
    """Highest fare per airline combination and route (and further columns), for some leg counts."""
    if "num_legs" in df.columns:
        keep = F.col("num_legs").isin(list(legs))  # reaches the scan of a stored table
    else:
        keep = reduce(Column.__or__, [LEG_TESTS[n]() for n in legs])
    return (
        df.where(keep & F.col("base_fare").isNotNull())
        .groupBy(_airline(), "starting_airport", "destination_airport", *by)
        .agg(F.max("base_fare").alias("base_fare"))
    )


def top_fares(df: DataFrame, *legs: int) -> DataFrame:
    """Dearest itinerary of each airline combination among those with ``legs`` legs.

    Ties go to the first starting airport, then the first destination. A combination
    has one leg count, so several counts come out of one pass.
    """
    return dearest(carrier_routes(df, legs))


def dearest(cells: DataFrame) -> DataFrame:
    return first_route(cells, -F.col("base_fare"))


def carrier_max_fare_join(df: DataFrame) -> DataFrame:
    """Every route on which an airline combination charges its highest fare.

    The rows of the self-join of itineraries with their airline's maximum, all ties
    kept, from one pass. Equal itineraries are counted before they are shuffled, and
    the filter on the rank drops all but each task's best before the second shuffle,
    so neither a shared fare nor a large airline gathers in one task.
    """
    cells = (
        df.where(F.col("segments_airline_name").isNotNull() & F.col("base_fare").isNotNull())
        .groupBy(_airline(), "starting_airport", "destination_airport", "base_fare")
        .agg(F.count("*").alias("num_itineraries"))
    )
    by_fare = Window.partitionBy("airline_name").orderBy(F.col("base_fare").desc())
    return cells.withColumn("place", F.rank().over(by_fare)).where("place = 1").drop("place")


def carrier_dedupe(df: DataFrame) -> DataFrame:
    """One row per airline combination: the first by route, then by fare."""
    cells = (
        df.where(F.col("segments_airline_name").isNotNull())
        .groupBy(_airline(), "starting_airport", "destination_airport")
        .agg(F.min("base_fare").alias("base_fare"))
    )
    return first_route(cells)


def carrier_maxima(df: DataFrame) -> DataFrame:
    """Highest fare per airline combination, without the route it belongs to."""
    return df.groupBy(_airline()).agg(F.max("base_fare").alias("base_fare"))


def layover_mean_fares(dearest_fares: DataFrame) -> DataFrame:
    """Mean over the two-leg and over the three-leg table of dearest fares: one row.

    ``dearest_fares`` has one row per airline combination: the stored result tables, or
    the maxima alone, which take one pass.
    """
    legs, fare = leg_count("airline_name"), F.col("base_fare")
    return dearest_fares.agg(
        exact_avg(F.when(legs == 2, fare)).alias("one_layover_mean"),
        exact_avg(F.when(legs == 3, fare)).alias("two_layover_mean"),
    )


def avg_fare_by_airline(df: DataFrame, first: date, end: date) -> DataFrame:
    """Average base fare per airline in ``[first, end)``.

    An itinerary counts once for each airline that flies a leg of it.
    """
    return (
        departing(df, first, end)
        .select(
            F.explode(F.array_distinct(segment_list("segments_airline_name"))).alias(
                "airline_name"
            ),
            "base_fare",
        )
        .groupBy("airline_name")
        .agg(
            F.count("*").alias("num_itineraries"),
            exact_avg("base_fare").alias("average_base_fare"),
        )
    )


def legs_histogram(df: DataFrame) -> DataFrame:
    """Itineraries per number of legs; malformed lists have none and are left out."""
    return (
        df.where(F.col("num_legs").isNotNull())
        .groupBy("num_legs")
        .agg(F.count("*").alias("num_itineraries"))
    )


def explode_segments(df: DataFrame) -> DataFrame:
    """One row per leg from the segment columns that are present, numbered from 1."""
    present = [c for c in SEGMENT_COLUMNS if c in df.columns]
    # a missing list is an empty one; an itinerary drops out only when all its lists are missing
    empty = F.array().cast("array<string>")
    zipped = F.arrays_zip(*[F.coalesce(segment_list(c), empty).alias(c) for c in present])
    return df.select("leg_id", F.posexplode(zipped).alias("pos", "seg")).select(
        "leg_id",
        (F.col("pos") + 1).alias("segment_no"),
        *[
            F.col(f"seg.{c}").try_cast(SEGMENT_COLUMNS[c][1]).alias(SEGMENT_COLUMNS[c][0])
            for c in present
        ],
    )
