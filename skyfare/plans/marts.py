"""Building, storing and reading the ten result tables.

A full build reads the itinerary table twice, each time into a small stored rollup
from which all ten tables follow:

- ``route_days``: counts, sums and extremes per (start, destination, day)
- ``carrier_routes``: highest fare per (airline combination, start, destination, month)

Sums of decimals are exact, so a table made from a rollup equals the one made from
the rows. Rollups are written tables, not cached blocks: a lost executor costs a
re-read, never a rebuild.

Both rollups are kept by month, so ``update`` reads the itineraries of changed months only. A build or an
update writes a folder of its own and becomes current at its end, in one step (``sources.versions``).
"""

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfare.functions.expr import exact_avg, fare_text, in_season, leg_count, ratio
from skyfare.operators.carriers import carrier_routes, dearest
from skyfare.operators.fares import rows_at
from skyfare.operators.inserts import insert_ignore
from skyfare.operators.routes import ROUTE
from skyfare.sources import versions
from skyfare.sources.lookup import lookup, write_lookup

#: Folders of the fares by route.
ROUTE_BUCKETS = 64
#: Month of flights without a date.
NO_MONTH = 0


def flight_month() -> Column:
    """A number like 202206."""
    return F.coalesce(F.year("flight_date") * 100 + F.month("flight_date"), F.lit(NO_MONTH)).alias("flight_month")


def route_days(df: DataFrame) -> DataFrame:
    return df.groupBy("starting_airport", "destination_airport", "flight_date").agg(
        F.count("leg_id").alias("flights"),
        F.count("*").alias("itineraries"),
        F.sum("base_fare").alias("fare_sum"),
        F.count("base_fare").alias("fares"),
        F.min("base_fare").alias("min_fare"),
        F.max("base_fare").alias("max_fare"),
        F.sum("total_travel_distance").alias("distance_sum"),
        F.count("total_travel_distance").alias("distances"),
    )


def result_tables(
    days: DataFrame,
    carriers: DataFrame | None,
    year: int,
    months: list[int],
    route: tuple[str, str],
) -> dict[str, DataFrame]:
    """The ten tables from the two rollups; without the second, those that need no airlines."""
    avg_fare = ratio(F.sum("fare_sum"), F.sum("fares"))
    season = days.where(in_season("flight_date", year, months)).groupBy("starting_airport")
    pair = days.where(
        (F.col("starting_airport") == route[0]) & (F.col("destination_airport") == route[1])
    )
    daily = (
        days.where(F.col("starting_airport").isNotNull())
        .groupBy("starting_airport", "flight_date")
        .agg(
            F.sum("flights").alias("n"),
            F.sum("fare_sum").alias("fare_sum"),
            F.sum("fares").alias("fares"),
        )
    )
    dest = days.groupBy("destination_airport").agg(
        F.min("min_fare").alias("min_base_fare"),
        F.max("max_fare").alias("max_base_fare"),
        avg_fare.alias("fare"),
    )
    distance = ratio(F.sum("distance_sum"), F.sum("distances"))

    def top(legs: int) -> DataFrame:
        return dearest(carriers.where(leg_count("airline_name") == legs))

    tops = {} if carriers is None else {f"{n}_leg_flights": top(i) for i, n in enumerate(("one", "two", "three"), 1)}
    return {
        "average_flight_prices": season.agg(avg_fare.alias("fare")).select(
            "starting_airport",
            F.bround("fare", 2).alias("average_base_fare"),
            fare_text("fare").alias("average_base_fare_text"),
        ),
        "route_average": pair.agg(avg_fare.alias("average_base_fare")),
        "starting_flights": daily.groupBy("starting_airport").agg(
            F.round(exact_avg("n")).cast("int").alias("average_flights_per_day"),
            F.round(avg_fare, 2).alias("average_cost"),
        ),
        "max_airport_base_fare": rows_at(
            dest.select("destination_airport", "max_base_fare"), "max_base_fare", F.max
        ),
        "min_airport_base_fare": rows_at(
            dest.select("destination_airport", "min_base_fare"), "min_base_fare", F.min
        ),
        "min_max_flights": dest.select(
            "destination_airport",
            "min_base_fare",
            "max_base_fare",
            F.bround("fare", 2).alias("average_base_fare"),
            fare_text("fare").alias("average_base_fare_text"),
        ),
        **tops,
        "travel_distance": days.groupBy("starting_airport")
        .agg(distance.alias("average_travel_distance"))
        .orderBy(F.col("average_travel_distance").desc(), "starting_airport"),
    }


def mart_path(folder: str, name: str) -> str:
    return f"{folder}/marts/{name}"


def _rollups(df: DataFrame) -> dict[str, DataFrame]:
    months = df.withColumn("flight_month", flight_month())
    carriers = carrier_routes(months, [1, 2, 3], "flight_month")
    return {"route_days": route_days(df).withColumn("flight_month", flight_month()), "carrier_routes": carriers}


def _published(
    spark: SparkSession, root: str, rollups: dict[str, DataFrame], year: int, months: list[int], route: tuple[str, str], ignore_known: bool
) -> dict[str, DataFrame]:
    """Writes rollups and the tables made of them, and makes them current."""
    before, folder = versions.current(spark, root), versions.new_folder(root)
    _together(lambda name: rollups[name].write.partitionBy("flight_month").parquet(f"{folder}/rollups/{name}"), rollups)
    days, carriers = (spark.read.schema(rollups[n].schema).parquet(f"{folder}/rollups/{n}") for n in ("route_days", "carrier_routes"))
    tables = result_tables(days, carriers, year, months, route)
    if ignore_known and before:
        tables = {n: insert_ignore(t, spark.read.schema(t.schema).parquet(mart_path(before, n))) for n, t in tables.items()}
    _together(lambda name: tables[name].write.parquet(mart_path(folder, name)), tables)
    two, three = (spark.read.schema(tables[n].schema).parquet(mart_path(folder, n)) for n in ("two_leg_flights", "three_leg_flights"))
    write_lookup(two.unionByName(three), f"{folder}/lookups/route_fares", ROUTE, ROUTE_BUCKETS)
    versions.publish(spark, root, folder)
    return read(spark, root, tables)


def build(
    spark: SparkSession,
    df: DataFrame,
    root: str,
    year: int,
    months: list[int],
    route: tuple[str, str],
    ignore_known: bool = False,
) -> dict[str, DataFrame]:
    """Write rollups and result tables under ``root`` and return the stored tables.

    By default each table is replaced, so a run on other data leaves no stale rows.
    ``ignore_known`` keeps the rows of tables that exist already and adds unseen ones. Readers see the tables of the
    last build until all of this one's are written, and go on to if it fails.
    """
    return _published(spark, root, _rollups(df), year, months, route, ignore_known)


def update(
    spark: SparkSession,
    df: DataFrame,
    root: str,
    changed: list[int],
    year: int,
    months: list[int],
    route: tuple[str, str],
) -> dict[str, DataFrame]:
    """The tables of a full build after the itineraries of some months (like 202206; NO_MONTH without a date) have changed.

    Only itineraries of ``changed`` months are read from ``df``; on the lake, that is their partitions. Other
    months come from the rollups of the current build.
    """
    folder = versions.current(spark, root)
    if folder is None:
        raise ValueError(f"nothing is built in {root}")
    dated = [m for m in changed if m != NO_MONTH]
    if "flight_month" in df.columns:
        keep = F.col("flight_month").isin(dated)
        keep = keep | F.col("flight_month").isNull() if NO_MONTH in changed else keep
    else:
        keep = flight_month().isin(list(changed))
    fresh = _rollups(df.where(keep).drop("flight_month"))
    merged = {}
    for name, rows in fresh.items():
        known = spark.read.schema(rows.schema).parquet(f"{folder}/rollups/{name}")
        merged[name] = known.where(~F.col("flight_month").isin(list(changed))).unionByName(rows)
    return _published(spark, root, merged, year, months, route, False)


def _together(store, names) -> None:
    """Submit independent writes at the same time; small ones would leave the cluster idle."""
    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(store, names))


def _current(spark: SparkSession, root: str) -> str:
    folder = versions.current(spark, root)
    if folder is None:
        raise ValueError(f"nothing is built in {root}")
    return folder


def read(spark: SparkSession, root: str, names) -> dict[str, DataFrame]:
    """Tables of the current build."""
    folder = _current(spark, root)
    return {name: spark.read.parquet(mart_path(folder, name)) for name in names}


def read_rollup(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``route_days`` or ``carrier_routes`` of the current build."""
    return spark.read.parquet(f"{_current(spark, root)}/rollups/{name}")


def route_fares(spark: SparkSession, root: str, start: str | None, dest: str | None) -> DataFrame:
    """The dearest fares of one pair with one and two layovers, from one folder of the current build."""
    values = dict(zip(ROUTE, (start, dest)))
    return lookup(spark, f"{_current(spark, root)}/lookups/route_fares", ROUTE_BUCKETS, **values)


def melted(tables: dict[str, DataFrame]) -> DataFrame:
    """All numbers of some tables: table_name, row_key (the row's texts), column_name, value."""
    parts = []
    for name, df in tables.items():
        keys = [F.coalesce(F.col(c), F.lit("")) for c, t in df.dtypes if t == "string" and not c.endswith("_text")]
        numbers = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c, t in df.dtypes if t != "string"]
        rows = df.select(F.lit(name).alias("table_name"), F.concat_ws("|", *keys).alias("row_key"), F.explode(F.array(*numbers)).alias("n"))
        parts.append(rows.select("table_name", "row_key", "n.*"))
    return reduce(DataFrame.unionByName, parts)


def differences(expected: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows that are in one of the two and not in the other, copies counted."""
    stored = stored.select(*expected.columns)
    missing = expected.exceptAll(stored).withColumn("side", F.lit("missing"))
    return missing.unionByName(stored.exceptAll(expected).withColumn("side", F.lit("extra")))


# --- JDBC ------------------------------------------------------------------


def jdbc_column_types(df: DataFrame, width: int = 255) -> str:
    """Text columns as VARCHAR: an equality filter can then run in the database."""
    names = [f.name for f in df.schema if f.dataType.typeName() == "string"]
    return ", ".join(f"{n} VARCHAR({width})" for n in names)


def write_jdbc(
    df: DataFrame, url: str, name: str, options: dict | None = None, mode: str = "overwrite"
) -> None:
    """Store a result table in a database, in batches and from parallel tasks."""
    writer = df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", name)
    types = jdbc_column_types(df)
    if types:
        writer = writer.option("createTableColumnTypes", types)
    writer.options(**(options or {})).save()


def read_jdbc(spark: SparkSession, url: str, name: str, options: dict | None = None) -> DataFrame:
    """A database table as a frame; filters with literals run in the database."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", name)
    return reader.options(**(options or {})).load()
