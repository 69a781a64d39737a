"""Rankings within periods, and figures of periods that overlap."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfare.functions.expr import exact_avg, ratio, segment_list


def period_start(period: str, c: str = "flight_date") -> Column:
    """First day of the ``month``, ``quarter``, ``season`` or ``year`` of a date.

    Seasons begin with December, March, June and September.
    """
    if period == "season":
        return F.add_months(F.trunc(F.add_months(F.col(c), 1), "quarter"), -1)
    if period not in ("month", "quarter", "year"):
        raise ValueError(f"no such period: {period}")
    return F.trunc(c, period)


def top_per_period(cells: DataFrame, measure: str, k: int, period: str = "period_start") -> DataFrame:
    """The ``k`` rows of greatest ``measure`` in each period, all that tie with the last of them included.

    ``place`` is one plus the number of greater rows. Rows without the measure have no place. The limit
    is taken in each task before rows are shuffled, so a period gathers a few rows of each task only.
    """
    order = Window.partitionBy(period).orderBy(F.col(measure).desc())
    return cells.where(F.col(measure).isNotNull()).withColumn("place", F.rank().over(order)).where(F.col("place") <= k)


def destinations_by_period(df: DataFrame, period: str) -> DataFrame:
    """Flights into each destination and their average fare, by period. Flights without a date are left out."""
    return (
        df.where(F.col("flight_date").isNotNull())
        .groupBy(period_start(period).alias("period_start"), "destination_airport")
        .agg(F.count("*").alias("num_flights"), exact_avg("base_fare").alias("average_base_fare"))
    )


def most_popular(df: DataFrame, k: int, period: str) -> DataFrame:
    """The destinations with most flights in each period."""
    return top_per_period(destinations_by_period(df, period), "num_flights", k)


def most_expensive(df: DataFrame, k: int, period: str) -> DataFrame:
    """The destinations with the highest average fare in each period."""
    return top_per_period(destinations_by_period(df, period), "average_base_fare", k)


def _month_number(c: str) -> Column:
    return F.year(c) * 12 + F.month(c) - 1


def _month_date(number: Column) -> Column:
    return F.make_date(F.floor(number / 12).cast("int"), (number % 12 + 1).cast("int"), F.lit(1))


def airline_months(df: DataFrame) -> DataFrame:
    """Sums that add up, per airline and month: an itinerary counts once for each airline that flies a leg of it."""
    airline = F.explode(F.array_distinct(segment_list("segments_airline_name"))).alias("airline_name")
    rows = df.where(F.col("flight_date").isNotNull()).select(airline, "base_fare", _month_number("flight_date").alias("month"))
    return rows.groupBy("airline_name", "month").agg(
        F.count("*").alias("itineraries"), F.sum("base_fare").alias("fare_sum"), F.count("base_fare").alias("fares")
    )


def avg_fare_by_airline_rolling(months: DataFrame, length: int = 4) -> DataFrame:
    """Average fare of each airline in every period of ``length`` months in which it has an itinerary.

    ``months`` is a stored rollup by month (``airline_months``). Months without flights get a row without figures, up to
    the last period a flight is in, and a range frame over month numbers adds up each period. A period is
    [period_start, period_end).
    """
    span = months.groupBy("airline_name").agg(F.min("month").alias("lo"), F.max("month").alias("hi"))
    calendar = span.select("airline_name", F.explode(F.sequence("lo", F.col("hi") + (length - 1))).alias("month"))
    every = calendar.join(months, ["airline_name", "month"], "left")
    frame = Window.partitionBy("airline_name").orderBy("month").rangeBetween(-(length - 1), Window.currentRow)
    sums = every.select("airline_name", "month", *[F.sum(c).over(frame).alias(c) for c in ("itineraries", "fare_sum", "fares")])
    first = F.col("month") - (length - 1)
    return sums.where("itineraries > 0").select(
        "airline_name",
        _month_date(first).alias("period_start"),
        _month_date(F.col("month") + 1).alias("period_end"),
        F.col("itineraries").alias("num_itineraries"),
        ratio(F.col("fare_sum"), F.col("fares")).alias("average_base_fare"),
    )
