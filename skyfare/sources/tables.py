"""Itinerary relations derived from the star-schema tables.

An order with its lines plays the part of an itinerary with its legs. Only the
joins and aggregates that the requested columns need are put into the plan, so a
query over dates and fares never touches parts or suppliers.

Joins to the dimensions are left joins on their keys: they add columns and never
drop a leg, which is what makes leaving one out exact. No join carries a broadcast
hint; Spark broadcasts a side only when its known size is under the session's
threshold and shuffles otherwise, splitting skewed partitions.
"""

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfare.functions.constants import SEGMENT_COLUMNS, SEGMENT_SEPARATOR
from skyfare.functions.expr import in_date_range
from skyfare.sources.checkpoint import stored

COLUMNS = [
    "leg_id",
    "flight_date",
    "starting_airport",
    "destination_airport",
    "is_nonstop",
    "is_refundable",
    "base_fare",
    "total_fare",
    "seats_remaining",
    "travel_duration",
    "total_travel_distance",
    "segments_airline_name",
    "num_legs",
]

_CODE = "concat('N', lpad(cast({} as string), 2, '0'))"


def _joined(texts: str) -> str:
    """An array of texts, one per leg in leg order, as a list; a NULL keeps its place."""
    return f"array_join({texts}, '{SEGMENT_SEPARATOR}', '')"


def _clock(second: str) -> str:
    day = f"date_from_unix_date(cast({second} div 86400 as int))"
    hour = f"lpad(cast({second} % 86400 div 3600 as string), 2, '0')"
    minute = f"lpad(cast({second} % 3600 div 60 as string), 2, '0')"
    return f"concat(cast({day} as string), 'T', {hour}, ':', {minute})"


# A leg leaves on its ship date, at the hour of its line number.
_LEAVES = "(unix_date(cast(l_shipdate as date)) * 86400L + l_linenumber * 3600)"
_SECONDS = "cast(l_quantity as int) * 300"
_LANDS = f"({_LEAVES} + {_SECONDS})"

# Segment column -> text of one leg, over a line with its supplier, nation and part.
_LEG_TEXTS = {
    "segments_airline_name": "n_name",
    "segments_airline_code": _CODE.format("s_nationkey"),
    "segments_arrival_airport_code": _CODE.format("s_nationkey"),
    "segments_departure_time_epoch_seconds": f"cast({_LEAVES} as string)",
    "segments_departure_time_raw": _clock(_LEAVES),
    "segments_arrival_time_epoch_seconds": f"cast({_LANDS} as string)",
    "segments_arrival_time_raw": _clock(_LANDS),
    "segments_equipment_description": "p_type",
    "segments_duration_in_seconds": f"cast({_SECONDS} as string)",
    "segments_distance": "cast(p_size as string)",
    "segments_cabin_code": "l_returnflag",
}

_HOME = _CODE.format("c_nationkey")

# Requested column -> expression over an order, its customer and the facts of its lines.
_COLUMNS = {
    "leg_id": "o_orderkey",
    "flight_date": "cast(o_orderdate as date)",
    "starting_airport": _HOME,
    "destination_airport": _CODE.format("last_nation"),
    "is_nonstop": "num_legs = 1",
    "is_refundable": "o_orderstatus = 'F'",
    "base_fare": "cast(o_totalprice as decimal(18,2))",
    "total_fare": "cast(cast(o_totalprice as decimal(18,2)) + 4.50 * num_legs as decimal(18,2))",
    "seats_remaining": "seats",
    "travel_duration": "concat('PT', minutes div 60, 'H', minutes % 60, 'M')",
    "total_travel_distance": "if(miles % 10 = 0, null, miles)",
    "num_legs": "num_legs",
    # a leg departs where the one before it has landed
    "segments_departure_airport_code": _joined(f"concat(array({_HOME}), stops)"),
    **{c: c for c in _LEG_TEXTS},
    # some itineraries do not say what they fly with
    "segments_equipment_description": (
        "if(o_orderkey % 7 = 0, null, segments_equipment_description)"
    ),
}

# Fact of an order's lines -> its aggregate and the columns made from it.
_FACTS = {
    "num_legs": ("cast(count(*) as int)", {"num_legs", "is_nonstop", "total_fare"}),
    "seats": ("cast(min(l_quantity) as int)", {"seats_remaining"}),
    "minutes": ("cast(sum(l_quantity) as int) + 30", {"travel_duration"}),
    "miles": ("cast(sum(p_size) as int)", {"total_travel_distance"}),
}
_LISTS = set(SEGMENT_COLUMNS)
_FROM_PART = {"total_travel_distance", "segments_distance", "segments_equipment_description"}
_FROM_CUSTOMER = {"starting_airport", "segments_departure_airport_code"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airport dimension: iata, long, lat."""
    return table(spark, sf_dir, "nation").selectExpr(
        f"{_CODE.format('n_nationkey')} as iata",
        "cast(2 * n_nationkey - 120 as double) as long",
        "cast(n_nationkey + 25 as double) as lat",
    )


def itineraries(
    spark: SparkSession,
    sf_dir: str,
    columns: Iterable[str] | None = None,
    legs: Iterable[int] | None = None,
    dates: tuple[date, date] | None = None,
    start: str | None = None,
) -> DataFrame:
    """One row per order that has lines, with the requested columns.

    ``legs`` keeps itineraries with one of these leg counts, ``dates`` those that
    depart in ``[first, end)``, ``start`` those from one airport. All cut the lines down
    before they are reduced and segment lists are put together.
    """
    columns = list(COLUMNS if columns is None else columns)
    want = set(columns)
    orders = table(spark, sf_dir, "orders")
    if dates is not None:
        orders = orders.where(in_date_range(F.to_date("o_orderdate"), *dates))
    if start is not None:
        home = table(spark, sf_dir, "customer").where(F.expr(_HOME) == start)
        orders = orders.join(home, F.expr("o_custkey = c_custkey"), "left_semi")
    trips = _trips(spark, sf_dir, want, legs, None if dates is None and start is None else orders)

    # with no fact to add, the lines only say which orders are itineraries
    how = "left_semi" if trips.columns == ["l_orderkey"] else "inner"
    # lists are wide: unless legs select few, orders meet their customers before they get them
    first = bool(want & _LISTS) and legs is None
    if first:
        orders = _with_customer(spark, sf_dir, want, orders)
    df = orders.join(trips, F.expr("o_orderkey = l_orderkey"), how)
    if not first:
        df = _with_customer(spark, sf_dir, want, df)
    return df.selectExpr(*[f"{_COLUMNS[c]} as {c}" for c in columns])


def _with_customer(spark: SparkSession, sf_dir: str, want: set[str], orders: DataFrame) -> DataFrame:
    if not want & _FROM_CUSTOMER:
        return orders
    return orders.join(table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey"), "left")


def _named_suppliers(spark: SparkSession, suppliers: DataFrame, nation: DataFrame) -> DataFrame:
    """Suppliers with their nation's key and name, stored.

    The small sides meet first, so that lines meet a supplier key and never one of few nations. Spark takes a join to be
    as large as the product of its sides; a table has a known size, and lines are not shuffled for one under the threshold.
    """
    named = suppliers.join(nation, F.expr("s_nationkey = n_nationkey"), "left")
    return stored(named.select("s_suppkey", "s_nationkey", "n_name"), "named-suppliers")


def _trips(
    spark: SparkSession,
    sf_dir: str,
    want: set[str],
    legs: Iterable[int] | None,
    orders: DataFrame | None,
) -> DataFrame:
    """Per order, the facts its lines give; ``l_orderkey`` alone when none is wanted.

    ``orders``, if given, is a selection of orders whose lines are enough.
    """
    lines = table(spark, sf_dir, "lineitem")
    suppliers = table(spark, sf_dir, "supplier")
    of_supplier = F.expr("l_suppkey = s_suppkey")

    if legs is not None:
        counts = lines.groupBy(F.col("l_orderkey").alias("k")).agg(F.count("*").alias("n"))
        kept = counts.where(F.col("n").isin(sorted(legs)))
        lines = lines.join(kept, F.expr("l_orderkey = k"), "left_semi")
    if orders is not None:
        lines = lines.join(orders, F.expr("l_orderkey = o_orderkey"), "left_semi")
    if want & _FROM_PART:
        part = table(spark, sf_dir, "part")
        lines = lines.join(part, F.expr("l_partkey = p_partkey"), "left")

    facts = [F.expr(f"{sql} as {name}") for name, (sql, uses) in _FACTS.items() if uses & want]
    order = "l_linenumber, l_partkey, l_suppkey"
    if want & _LISTS:
        lines = lines.join(_named_suppliers(spark, suppliers, table(spark, sf_dir, "nation")), of_supplier, "left")
        if legs is None and orders is None:
            # lists gain nothing from partial aggregation: shuffle the legs, not half-made
            # lists; a selection above has partitioned its few legs by order already
            lines = lines.repartition("l_orderkey")
        texts = [c for c in _LEG_TEXTS if c in want]
        if "segments_departure_airport_code" in want:
            texts = sorted({*texts, "segments_arrival_airport_code"})
        if want & (_LISTS - {"segments_airline_name"}):
            order += ", l_quantity, l_returnflag"
        leg = ", ".join([order, "s_nationkey", *texts])
        lines = lines.withColumns({c: F.expr(_LEG_TEXTS[c]) for c in texts})
        facts.append(F.expr(f"array_sort(collect_list(struct({leg}))) as trip"))
    elif "destination_airport" in want:
        facts.append(F.expr(f"max(struct({order})).l_suppkey as last_supplier"))
    if not facts:
        return lines.select("l_orderkey").distinct()

    df = lines.groupBy("l_orderkey").agg(*facts)
    if want & _LISTS:
        # lists are put together here, and the legs let go: the joins to come move the texts only
        lists = {c: F.expr(_joined(f"trip.{c}")) for c in _LEG_TEXTS if c in want}
        df = df.withColumns({"last_nation": F.expr("element_at(trip, -1).s_nationkey"), **lists})
        if "segments_departure_airport_code" in want:
            df = df.withColumn("stops", F.expr("slice(trip.segments_arrival_airport_code, 1, size(trip) - 1)"))
        return df.drop("trip")
    if "destination_airport" in want:
        # one lookup per itinerary, after the legs have been reduced to the last one
        df = df.join(suppliers, F.expr("last_supplier = s_suppkey"), "left")
        return df.withColumnRenamed("s_nationkey", "last_nation")
    return df
