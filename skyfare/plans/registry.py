"""Every operator as a named query over the tables of one data directory."""

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfare.functions.constants import SEGMENT_COLUMNS, SOURCE_COLUMNS
from skyfare.operators import airports as ap
from skyfare.operators import carriers as ca
from skyfare.operators import extract as ex
from skyfare.operators import fares as fa
from skyfare.operators import filters as fi
from skyfare.operators import inserts as ins
from skyfare.operators import periods as pe
from skyfare.operators import routes as ro
from skyfare.operators import segments as se
from skyfare.operators import text as tx
from skyfare.plans import comparison as co
from skyfare.plans import marts
from skyfare.plans import summary as su
from skyfare.sources import tables
from skyfare.sources import itineraries as csv
from skyfare.sources import quarantine as qu
from skyfare.sources import versions
from skyfare.sources.checkpoint import new_folder, stored
from skyfare.sources.itineraries import chunk_union
from skyfare.sources.tables import itineraries

# The test tables hold 1995 to 2001, so the season is summer 2000.
YEAR, SUMMER = 2000, [6, 7, 8]
SEASON = (date(2000, 6, 1), date(2000, 9, 1))
PERIOD = (date(2000, 5, 1), date(2000, 9, 1))
START, DEST = "N05", "N11"
CODES = [f"N{i:02d}" for i in range(16)]
BUDGET, CHUNK_ROWS = 200_000, 1_000
TOP, ROLLING_MONTHS = 3, 4

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ORIGIN, TARGET, FARE = "starting_airport", "destination_airport", "base_fare"
AIRLINES, ROUTE = "segments_airline_name", ["starting_airport", "destination_airport"]
CARRIER_COLUMNS = [AIRLINES, *ROUTE, FARE]


def query(f: Query) -> Query:
    """Register under the function's name. Money leaves as double, like the stored tables."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = f(spark, sf_dir)
        return df.select(
            [
                F.col(c).cast("double").alias(c) if kind.startswith("decimal") else F.col(c)
                for c, kind in df.dtypes
            ]
        )

    QUERIES[f.__name__] = run
    return f


# --- scans, projections, filters --------------------------------------------


def _extract(spark, sf):
    return ex.extract_columns(itineraries(spark, sf), without=("search_date",))


@query
def extract_columns(spark, sf):
    return _extract(spark, sf)


@query
def systematic_sample(spark, sf):
    keys = itineraries(spark, sf, ["leg_id"])
    return ex.systematic_sample(_extract(spark, sf), ("leg_id",), keys=keys)


@query
def systematic_sample_text_id(spark, sf):
    """In the order of a date and of an id that is a text and comes more than once."""
    trips = itineraries(spark, sf, ["leg_id", "flight_date", *ROUTE, FARE])
    odd = F.when(F.col("leg_id") % 50 != 0, F.concat(F.lit("id"), F.col("leg_id") % 500))
    return ex.systematic_sample(trips.withColumn("text_id", odd), ("flight_date", "text_id"))


@query
def size_capped_extract(spark, sf):
    return ex.size_capped_extract(_extract(spark, sf), BUDGET, ("leg_id",), True)


@query
def size_capped_chunks(spark, sf):
    return ex.size_capped_chunks(_extract(spark, sf), BUDGET, CHUNK_ROWS, ("leg_id",), True)


@query
def chunk_union(spark, sf, union=chunk_union):
    """Two chunks with a year in common; flights without a date are in both."""
    trips = itineraries(spark, sf, ["leg_id", "flight_date", *ROUTE, FARE])
    day = F.when(F.col("leg_id") % 20 != 0, F.col("flight_date"))
    trips = trips.withColumn("flight_date", day)
    late, early = (F.col("flight_date") >= F.lit(date(y, 1, 1)) for y in (YEAR, YEAR - 1))
    return union(trips.where(~F.coalesce(late, F.lit(False))), trips.where(F.coalesce(early, F.lit(True))))


@query
def cast_flight_date(spark, sf):
    trips = itineraries(spark, sf, ["leg_id", "flight_date"])
    as_text = trips.withColumn("flight_date", F.col("flight_date").cast("string"))
    return fi.cast_flight_date(as_text)


@query
def drop_index_column(spark, sf):
    trips = itineraries(spark, sf, ["leg_id", "flight_date", FARE])
    return ex.drop_index_column(trips.withColumn("Unnamed: 0", F.col("leg_id")))


@query
def filter_season(spark, sf):
    trips = itineraries(spark, sf, ["leg_id", "flight_date", ORIGIN, FARE])
    return fi.season(trips, YEAR, SUMMER)


def _with_legs(spark, sf, legs):
    trips = itineraries(spark, sf, ["leg_id", AIRLINES, FARE])
    return fi.with_legs(trips, legs)


@query
def filter_one_leg(spark, sf):
    return _with_legs(spark, sf, 1)


@query
def filter_two_leg(spark, sf):
    return _with_legs(spark, sf, 2)


@query
def filter_three_leg(spark, sf):
    return _with_legs(spark, sf, 3)


@query
def filter_airport_list(spark, sf):
    return fi.airports_in(tables.airports(spark, sf), CODES)


# --- fares ------------------------------------------------------------------


@query
def avg_fare_season(spark, sf):
    trips = itineraries(spark, sf, [ORIGIN, "flight_date", FARE], dates=SEASON)
    return fa.avg_fare_season(trips, YEAR, SUMMER)


@query
def route_avg_fare(spark, sf):
    trips = itineraries(spark, sf, [*ROUTE, FARE], start=START)
    return fa.route_avg_fare(trips, START, DEST)


@query
def avg_cost_by_airport(spark, sf):
    return fa.avg_cost_by_airport(itineraries(spark, sf, [ORIGIN, FARE]))


def _into(spark, sf):
    return itineraries(spark, sf, [TARGET, FARE])


@query
def max_fare_by_dest(spark, sf):
    return fa.max_fare_by_dest(_into(spark, sf))


@query
def min_fare_by_dest(spark, sf):
    return fa.min_fare_by_dest(_into(spark, sf))


@query
def dest_max_fare(spark, sf):
    return fa.dest_max_fare(_into(spark, sf))


@query
def dest_min_fare(spark, sf):
    return fa.dest_min_fare(_into(spark, sf))


@query
def dest_fare_stats(spark, sf):
    return fa.dest_fare_stats(_into(spark, sf))


@query
def format_fare(spark, sf):
    return fa.format_fare(_into(spark, sf))


# --- airports ---------------------------------------------------------------


@query
def flights_per_airport_day(spark, sf):
    return ap.flights_per_airport_day(itineraries(spark, sf, ["leg_id", ORIGIN, "flight_date"]))


@query
def avg_flights_per_day(spark, sf):
    return ap.avg_flights(itineraries(spark, sf, ["leg_id", ORIGIN, "flight_date"]))


@query
def avg_flights_per_month(spark, sf):
    return ap.avg_flights(itineraries(spark, sf, ["leg_id", ORIGIN, "flight_date"]), "month")


@query
def airport_daily_flights_and_cost(spark, sf):
    trips = itineraries(spark, sf, ["leg_id", ORIGIN, "flight_date", FARE])
    return ap.airport_daily_flights_and_cost(trips)


def _distances(spark, sf):
    return itineraries(spark, sf, [ORIGIN, "total_travel_distance"])


@query
def avg_distance_by_airport(spark, sf):
    return ap.avg_distance_by_airport(_distances(spark, sf))


@query
def top_distance_airports(spark, sf):
    return ap.top_distance_airports(_distances(spark, sf))


# --- carriers ---------------------------------------------------------------


def _top(spark, sf, *legs):
    return ca.top_fares(itineraries(spark, sf, CARRIER_COLUMNS, legs=legs), *legs)


@query
def top_fare_one_leg(spark, sf):
    return _top(spark, sf, 1)


@query
def top_fare_two_leg(spark, sf):
    return _top(spark, sf, 2)


@query
def top_fare_three_leg(spark, sf):
    return _top(spark, sf, 3)


@query
def carrier_max_fare_join(spark, sf):
    return ca.carrier_max_fare_join(itineraries(spark, sf, CARRIER_COLUMNS))


@query
def carrier_dedupe(spark, sf):
    return ca.carrier_dedupe(itineraries(spark, sf, CARRIER_COLUMNS))


def _means(spark, sf):
    trips = itineraries(spark, sf, [AIRLINES, FARE], legs=[2, 3])
    return ca.layover_mean_fares(ca.carrier_maxima(trips))


@query
def layover_mean_fares(spark, sf):
    return _means(spark, sf)


@query
def avg_fare_by_airline_period(spark, sf):
    trips = itineraries(spark, sf, ["flight_date", AIRLINES, FARE], dates=PERIOD)
    return ca.avg_fare_by_airline(trips, *PERIOD)


@query
def avg_fare_by_airline_rolling(spark, sf):
    """Every period of four months: one pass over the facts makes the rollup by month, which is stored."""
    trips = itineraries(spark, sf, ["flight_date", AIRLINES, FARE])
    return pe.avg_fare_by_airline_rolling(stored(pe.airline_months(trips), "airline-months"), ROLLING_MONTHS)


@query
def legs_histogram(spark, sf):
    return ca.legs_histogram(itineraries(spark, sf, ["num_legs"]))


@query
def explode_segments(spark, sf):
    return ca.explode_segments(itineraries(spark, sf, ["leg_id", *SEGMENT_COLUMNS]))


def _timed_list(column: str, shift: int):
    """A list of times of which some have an offset, some have none, and some are missing."""
    mark = F.col("leg_id") + shift

    def timed(text, i):
        z = mark + i
        offset = F.when(z % 7 == 6, "").when(z % 3 == 0, "+05:30").when(z % 3 == 1, "-04:00").otherwise("Z")
        return F.when(z % 11 == 0, "").otherwise(F.concat(text, F.lit(":30.000"), offset))

    return F.array_join(F.transform(F.split(column, r"\|\|"), timed), "||").alias(column)


def _segment_times(spark, sf):
    lists = itineraries(spark, sf, ["leg_id", se.DEPARTURES, se.ARRIVALS])
    return se.segment_times(lists.select("leg_id", _timed_list(se.DEPARTURES, 0), _timed_list(se.ARRIVALS, 1)))


@query
def segment_times(spark, sf):
    return _segment_times(spark, sf)


@query
def itinerary_layovers(spark, sf):
    return se.layovers(_segment_times(spark, sf))


# --- routes -----------------------------------------------------------------


def _paths(spark, sf):
    return ro.flights_between(itineraries(spark, sf, ROUTE))


@query
def flights_between(spark, sf):
    return _paths(spark, sf)


@query
def avg_duration_by_route(spark, sf):
    return ro.avg_duration_by_route(itineraries(spark, sf, [*ROUTE, "travel_duration"]))


@query
def route_popularity(spark, sf):
    return ro.route_popularity(itineraries(spark, sf, [*ROUTE, "seats_remaining"]))


def _nonstop(spark, sf, period):
    trips = itineraries(spark, sf, ["leg_id", *ROUTE, "flight_date", "is_nonstop"])
    return ro.avg_nonstop_per_route(trips, period)


@query
def avg_nonstop_per_route(spark, sf):
    return _nonstop(spark, sf, "day")


@query
def avg_nonstop_per_route_month(spark, sf):
    return _nonstop(spark, sf, "month")


@query
def popularity_by_season(spark, sf):
    return ro.popularity_by_season(itineraries(spark, sf, ["flight_date", TARGET, FARE]))


@query
def most_popular_by_month(spark, sf):
    return pe.most_popular(itineraries(spark, sf, ["flight_date", TARGET, FARE]), TOP, "month")


@query
def most_popular_by_season(spark, sf):
    return pe.most_popular(itineraries(spark, sf, ["flight_date", TARGET, FARE]), TOP, "season")


@query
def most_expensive_by_season(spark, sf):
    return pe.most_expensive(itineraries(spark, sf, ["flight_date", TARGET, FARE]), TOP, "season")


@query
def route_direct_vs_layover(spark, sf):
    return ro.route_direct_vs_layover(itineraries(spark, sf, [*ROUTE, "num_legs", FARE]))


@query
def path_weight(spark, sf):
    weighted = ro.path_weight(_paths(spark, sf))
    return su.with_endpoints(weighted, tables.airports(spark, sf))


@query
def route_fare_lookup(spark, sf):
    return marts.route_fares(spark, _built(spark, sf), START, DEST).select(FARE)


# --- summaries --------------------------------------------------------------


SUMMARY_COLUMNS = ["leg_id", *ROUTE, "flight_date", FARE, "total_travel_distance"]


#: Folder of the stored build by application and data.
_BUILT: dict[tuple[str, str], str] = {}
RUN = {"year": YEAR, "months": SUMMER, "route": (START, DEST)}
BUILD_COLUMNS = [*SUMMARY_COLUMNS, AIRLINES]


def _flights(spark, sf):
    """What a build reads, which it does twice, as a stored table: the legs are joined and put together once."""
    return stored(itineraries(spark, sf, BUILD_COLUMNS), "flights")


def _built(spark, sf):
    """The stored tables of a build over ``sf``, which the first query that asks for them makes: one pass over the facts."""
    key = spark.sparkContext.applicationId, sf
    if key not in _BUILT or versions.current(spark, _BUILT[key]) is None:
        _BUILT[key] = new_folder(spark, "build")
        marts.build(spark, _flights(spark, sf), _BUILT[key], **RUN)
    return _BUILT[key]


def _days(spark, sf):
    """The stored rollup by route and day."""
    return marts.read_rollup(spark, _built(spark, sf), "route_days").drop("flight_month")


def _tops(spark, sf):
    """The stored dearest fares of two and three legs."""
    tables = marts.read(spark, _built(spark, sf), ("two_leg_flights", "three_leg_flights"))
    return tables["two_leg_flights"].unionByName(tables["three_leg_flights"])


def _summary(spark, sf):
    names = ("average_flight_prices", "starting_flights", "travel_distance", "min_max_flights")
    results = marts.read(spark, _built(spark, sf), names)
    departures = su.departures_from_marts(
        results["average_flight_prices"], results["starting_flights"], results["travel_distance"]
    )
    return su.airport_summary(departures, results["min_max_flights"])


def _requests(days):
    """Every pair with an itinerary, and pairs of which one airport is not known."""
    pairs = days.select(*ROUTE).distinct()
    start, dest = (F.col(c) for c in ROUTE)
    odd = F.concat(F.lit("X"), start), F.concat(F.lit("X"), dest)
    return pairs.union(pairs.select(odd[0], dest)).union(pairs.select(start, odd[1])).toDF(*ROUTE)


def _layovers(spark, sf):
    """One row per airport, from stored tables of a row per airport or airline combination."""
    return su.airport_layover_difference(_summary(spark, sf), ca.layover_mean_fares(_tops(spark, sf)))


@query
def mart_build(spark, sf):
    """All numbers of the ten result tables, as a build stores them."""
    root = new_folder(spark, "marts")
    return marts.melted(marts.build(spark, _flights(spark, sf), root, **RUN))


@query
def mart_update(spark, sf):
    """The same, from a build without the flights of one summer and an update with them."""
    trips, root = _flights(spark, sf), new_folder(spark, "marts")
    day = F.col("flight_date")
    less = trips.where((day < F.lit(SEASON[0])) | (day >= F.lit(SEASON[1])))
    marts.build(spark, less, root, **RUN)
    return marts.melted(marts.update(spark, trips, root, [YEAR * 100 + m for m in SUMMER], **RUN))


@query
def airport_summary(spark, sf):
    return ap.airport_profile(itineraries(spark, sf, SUMMARY_COLUMNS), YEAR, SUMMER)


@query
def airport_summary_from_tables(spark, sf):
    return _summary(spark, sf)


@query
def airport_layover_difference(spark, sf):
    return _layovers(spark, sf)


@query
def airport_map_points(spark, sf):
    shown = fi.airports_in(tables.airports(spark, sf), CODES)
    return su.airport_map_points(_layovers(spark, sf), shown)


@query
def route_request_valid(spark, sf):
    days = _days(spark, sf)
    season = fi.season(days, YEAR, SUMMER).select(ORIGIN).distinct()
    return ro.route_request_valid(_requests(days), season)


@query
def route_layover_difference(spark, sf):
    requests = _requests(_days(spark, sf))
    return su.route_layover_difference(requests, _layovers(spark, sf), _tops(spark, sf))


@query
def route_line(spark, sf):
    return su.route_line(_requests(_days(spark, sf)), _layovers(spark, sf), tables.airports(spark, sf))


# --- writes and warm-ups ----------------------------------------------------


def _insert(spark, sf):
    """What a table of one-leg fares holds, and what comes in: part of it again, copies, NULLs."""
    trips = itineraries(spark, sf, ["leg_id", "flight_date", *CARRIER_COLUMNS], legs=[1])
    trips = trips.withColumnRenamed(AIRLINES, "airline_name")
    day = F.col("flight_date")
    trips = trips.withColumn(FARE, F.when(F.col("leg_id") % 10 != 0, F.col(FARE)))
    columns = ["airline_name", *ROUTE, FARE]
    existing = trips.where(day < F.lit(date(1999, 1, 1))).select(*columns).distinct()
    incoming = trips.where(day >= F.lit(date(1997, 1, 1))).select(*columns)
    return incoming.unionAll(incoming), existing


@query
def mart_insert_ignore(spark, sf):
    return ins.insert_ignore(*_insert(spark, sf))


@query
def mart_unseen_rows(spark, sf):
    return ins.unseen_rows(*_insert(spark, sf))


@query
def mart_insert_by_month(spark, sf):
    """A table kept by month after two appends, the second with rows that are known, copies and NULLs."""
    trips = itineraries(spark, sf, ["leg_id", "flight_date", *ROUTE, FARE])
    day = F.when(F.col("leg_id") % 30 != 0, F.col("flight_date"))
    rows = trips.select(day.alias("flight_date"), *ROUTE, F.when(F.col("leg_id") % 10 != 0, F.col(FARE)).alias(FARE))
    path = new_folder(spark, "by-month")
    ins.append_by_month(spark, rows.where(F.col("flight_date") < F.lit(date(1999, 1, 1))), path)
    late = rows.where(F.coalesce(F.col("flight_date") >= F.lit(date(1997, 1, 1)), F.lit(True)))
    ins.append_by_month(spark, late.unionAll(late), path)
    return ins.read_by_month(spark, path)


@query
def rollup_differences(spark, sf):
    """A stored rollup by month, of which one month lacks a route and another has one too many, against the rollup."""
    days = stored(_days(spark, sf).withColumn("flight_month", marts.flight_month()), "route-days")
    june, july = (F.col("flight_month") == YEAR * 100 + m for m in SUMMER[:2])
    odd = days.where(july & (F.col(ORIGIN) == START)).withColumn(ORIGIN, F.lit("ZZZ"))
    found = stored(days.where(~(june & (F.col(ORIGIN) == START))).unionByName(odd), "odd-days")
    out = co.differences_by_part(days, found, ["flight_month"])
    return out.select("flight_date", *ROUTE, "itineraries", "side")


@query
def csv_round_trip(spark, sf):
    """Itineraries written as CSV with the source's header and read back with their types."""
    trips = itineraries(spark, sf, ["leg_id", "flight_date", *ROUTE, FARE, "is_nonstop", AIRLINES])
    source = {engine: name for name, (engine, _) in SOURCE_COLUMNS.items()}
    path = new_folder(spark, "csv")
    csv.write_csv(trips.withColumnsRenamed(source), path)
    return csv.read_itineraries_csv(spark, path, ["leg_id", "flight_date", ORIGIN, FARE, "is_nonstop", AIRLINES])


@query
def csv_two_layouts(spark, sf):
    """Two sets of files whose headers differ in order, and of which each lacks a column of the other."""
    trips = itineraries(spark, sf, ["leg_id", "flight_date", *ROUTE, FARE, "is_nonstop"])
    late = F.col("flight_date") >= F.lit(date(YEAR, 1, 1))
    source = {engine: name for name, (engine, _) in SOURCE_COLUMNS.items()}
    old, new = trips.where(~late).drop("is_nonstop"), trips.where(late).select(FARE, TARGET, "is_nonstop", "leg_id", ORIGIN, F.lit("x").alias("note"))
    path = new_folder(spark, "layouts")
    csv.write_csv(old.withColumnsRenamed(source), f"{path}/old")
    csv.write_csv(new.withColumnsRenamed(source), f"{path}/new")
    return csv.read_itineraries_csv(spark, [f"{path}/old", f"{path}/new"], ["leg_id", "flight_date", *ROUTE, FARE, "is_nonstop"])


def _damaged_files(spark, sf):
    """Files of two layouts, of whose records some are too short, too long or badly quoted, and some cells do not parse."""
    trips = itineraries(spark, sf, ["leg_id", "flight_date", *ROUTE, FARE, "is_nonstop"])
    path, mark = new_folder(spark, "damaged"), F.col("leg_id") % 40
    fare = F.when(mark == 3, "n/a").otherwise(F.col(FARE).cast("string"))
    day = F.when(mark.isin(3, 7), "2000-13-45").otherwise(F.col("flight_date").cast("string"))
    cells = {"legId": F.col("leg_id"), "flightDate": day, "startingAirport": F.col(ORIGIN), "destinationAirport": F.col(TARGET),
             "baseFare": fare, "isNonStop": F.col("is_nonstop")}
    first = F.floor(F.col("leg_id") / 40) % 2 == 0
    headers = {"a": ["legId", "flightDate", "startingAirport", "destinationAirport", "baseFare"],
               "b": ["baseFare", "destinationAirport", "legId", "isNonStop", "startingAirport"]}
    for name, header in headers.items():
        texts = [F.coalesce(cells[c].cast("string"), F.lit("")) for c in header]
        line = F.concat_ws(",", *texts)
        line = F.when(mark == 11, F.concat_ws(",", *texts[:-1])).when(mark == 13, F.concat(line, F.lit(",zz"))).when(
            mark == 17, F.concat(texts[0], F.lit(',"'), F.concat_ws(",", *texts[1:]))).otherwise(line)
        rows = trips.where(first if name == "a" else ~first).select(line.alias(",".join(header)))
        # written as they are: neither separator nor quote is in a line
        rows.write.options(header=True, sep="\u0001", quote="\u0002", escape="\u0002").csv(f"{path}/{name}")
    return [f"{path}/{name}" for name in headers]


@query
def csv_accepted(spark, sf):
    """What a checked reading of damaged files accepts; accepted and refused records are written in one pass."""
    return qu.ingest(spark, _damaged_files(spark, sf), new_folder(spark, "ingested"))[0]


@query
def csv_quarantine(spark, sf):
    """Why records of damaged files are refused, by layout, reason and column."""
    refused = qu.ingest(spark, _damaged_files(spark, sf), new_folder(spark, "ingested"))[1]
    layout = F.regexp_extract("source_file", "/([ab])/[^/]*$", 1).alias("layout")
    return qu.refusals(refused).groupBy(layout, "reason", "column_name").agg(F.sum("num_problems").alias("num_problems"))


@query
def airport_file_round_trip(spark, sf):
    path = new_folder(spark, "airports")
    csv.write_csv(tables.airports(spark, sf), path)
    return csv.read_airports_csv(spark, path)


@query
def path_file_round_trip(spark, sf):
    """Flight paths with their positions, as a file of paths and read back."""
    paths = su.with_endpoints(_paths(spark, sf), tables.airports(spark, sf))
    path = new_folder(spark, "paths")
    csv.write_csv(paths.drop(*ROUTE), path)
    return csv.read_paths_csv(spark, path)


@query
def lake_season(spark, sf):
    """The season from itineraries stored by month."""
    path = new_folder(spark, "lake")
    csv.write_lake(itineraries(spark, sf, ["leg_id", "flight_date", *ROUTE, FARE]), path)
    return fi.season(csv.read_lake(spark, path), YEAR, SUMMER).drop("flight_month")


@query
def stored_table_differences(spark, sf):
    """A stored result table that lacks a destination and has one too many, against the result."""
    expected = fa.max_fare_by_dest(_into(spark, sf))
    odd = expected.where(F.col(TARGET) == DEST).withColumn(TARGET, F.lit("ZZZ"))
    found = stored(expected.where(F.col(TARGET) != DEST).unionByName(odd), "max-fares")
    return marts.differences(expected, found)


@query
def squares_even(spark, sf):
    return tx.squares_even(tables.table(spark, sf, "part"), "p_size")


@query
def tokenize_text(spark, sf):
    return tx.tokenize(tables.table(spark, sf, "documents"), "doc_id", "text")


