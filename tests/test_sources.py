from datetime import date
from decimal import Decimal

import pytest

from skyfare.functions.constants import EXTRACT_COLUMNS, SOURCE_COLUMNS
from skyfare.operators import carriers, extract, fares, filters
from skyfare.operators.inserts import append_unseen, insert_ignore, unseen_rows
from skyfare.operators.routes import path_weight
from skyfare.plans.marts import jdbc_column_types
from skyfare.sources import checkpoint, itineraries, tables
from tests.conftest import rows

HEADER = (
    "Unnamed: 0,legId,searchDate,flightDate,startingAirport,destinationAirport,isRefundable,"
    "isNonStop,baseFare,totalFare,seatsRemaining,travelDuration,totalTravelDistance,"
    "segmentsAirlineName"
)
LINES = [
    "0,a1,2022-04-16,2022-04-17,ATL,BOS,False,True,217.67,248.60,9,PT2H29M,947,Delta",
    "1,a2,2022-04-16,2022-04-17,ATL,BOS,False,False,99.5,251.10,3,PT4H,,Delta||Delta",
    "2,a3,xx,xx,ATL,BOS,maybe,False,xx,318.60,1.5,,1462,\"Air \"\"One\"\", Inc||B\"",
]


@pytest.fixture()
def csv(tmp_path):
    path = tmp_path / "itineraries.csv"
    path.write_text("\n".join([HEADER, *LINES]) + "\n")
    return str(path)


def test_csv_is_typed_and_dirty_cells_are_null(spark, csv):
    df = itineraries.read_itineraries_csv(spark, csv)
    assert df.columns == [*EXTRACT_COLUMNS, "num_legs"]
    assert dict(df.dtypes)["base_fare"] == "decimal(18,2)"
    got = {r.leg_id: r for r in df.collect()}
    assert got["a1"].flight_date == date(2022, 4, 17) and got["a1"].is_nonstop is True
    assert got["a2"].base_fare == Decimal("99.50") and got["a2"].total_travel_distance is None
    bad = got["a3"]
    assert bad.flight_date is None and bad.base_fare is None and bad.is_refundable is None
    assert bad.segments_airline_name == 'Air "One", Inc||B'
    assert [got[k].num_legs for k in ("a1", "a2", "a3")] == [1, 2, 2]


def test_rejects_are_counted(spark, csv):
    counts = itineraries.count_rejects(spark, csv).first().asDict()
    assert {k: v for k, v in counts.items() if v} == {
        "search_date": 1, "flight_date": 1, "is_refundable": 1, "base_fare": 1,
        "seats_remaining": 1,
    }


def test_csv_scan_reads_only_named_columns(spark, csv):
    df = itineraries.read_itineraries_csv(spark, csv, ["flight_date", "base_fare"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<flightDate:string,baseFare:string>" in plan


def test_csv_round_trip(spark, csv, tmp_path):
    df = itineraries.read_itineraries_csv(spark, csv)
    out = str(tmp_path / "out")
    raw = itineraries.rename_source(itineraries.read_raw_csv(spark, csv))
    names = {engine: source for source, (engine, _) in SOURCE_COLUMNS.items()}
    itineraries.write_csv(raw.toDF(*[names[c] for c in raw.columns]), out)
    assert rows(itineraries.read_itineraries_csv(spark, out)) == rows(df)


def test_singular_header_is_known(spark):
    df = spark.createDataFrame([("1", "x")], "segmentsDepartureTimeEpochSecond string, zzz string")
    assert itineraries.rename_source(df).columns == ["segments_departure_time_epoch_seconds"]


def test_dimension_files(spark, tmp_path):
    airports = tmp_path / "airports.csv"
    airports.write_text(
        "iata,airport,lat,long,cnt\nATL,Hartsfield,33.64,-84.43,9\nXXX,?,n/a,1,2\n"
    )
    assert rows(itineraries.read_airports_csv(spark, str(airports))) == [
        ("ATL", -84.43, 33.64), ("XXX", 1.0, None)
    ]
    paths = tmp_path / "paths.csv"
    paths.write_text(
        "start_lat,start_lon,end_lat,end_lon,airline,cnt\n1,2,3,4,AA,40\n5,6,7,8,AA,10\n"
    )
    weighted = path_weight(itineraries.read_paths_csv(spark, str(paths)))
    assert rows(weighted) == [(10, 6.0, 5.0, 8.0, 7.0, 0.25), (40, 2.0, 1.0, 4.0, 3.0, 1.0)]


def test_union_keeps_copies(spark):
    a = spark.createDataFrame([(1, "x")], "id int, t string")
    b = spark.createDataFrame([("x", 1)], "t string, id int")
    assert rows(itineraries.chunk_union(a, b, a)) == [(1, "x")] * 3


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lake_prunes_months(spark, trips, tmp_path):
    days = ["2022-05-31", "2022-06-30", "2022-12-31", "2023-01-01", None]
    df = trips(
        [{"flight_date": d, "base_fare": 10, "starting_airport": "A",
          "segments_airline_name": "X"} for d in days]
    )
    path = str(tmp_path / "lake")
    itineraries.write_lake(df, path)
    lake = itineraries.read_lake(spark, path)
    assert rows(lake.select(*df.columns)) == rows(df)

    june = filters.season(lake, 2022, [6, 7, 8])
    assert [r.flight_date for r in june.collect()] == [date(2022, 6, 30)]
    scan = plan_of(june)
    assert "PartitionFilters: [isnotnull(flight_month" in scan
    assert "flight_month#" in scan and "202206" in scan and "202208" in scan
    assert rows(fares.avg_fare_season(lake, 2022, [12])) == [("A", 10.0, "10.00")]
    period = carriers.avg_fare_by_airline(lake, date(2022, 12, 1), date(2023, 2, 1))
    assert rows(period) == [("X", 2, 10.0)]


def test_lake_point_filter_is_pushed(spark, trips, tmp_path):
    path = str(tmp_path / "lake")
    df = trips([{"flight_date": "2022-06-01", "starting_airport": "A", "base_fare": 1}])
    itineraries.write_lake(df, path)
    scan = plan_of(fares.route_avg_fare(itineraries.read_lake(spark, path), "A", "B"))
    assert "EqualTo(starting_airport,A)" in scan
    assert "ReadSchema: struct<starting_airport:string,destination_airport:string,base_fare:" in scan


def test_insert_ignore(spark):
    schema = "airport string, fare double"
    existing = spark.createDataFrame([("A", 1.0), (None, 2.0)], schema)
    incoming = spark.createDataFrame(
        [("A", 1.0), ("A", 3.0), ("A", 3.0), (None, 2.0), (None, None)], schema
    )
    assert rows(unseen_rows(incoming, existing)) == [("A", 3.0), (None, None)]
    once = insert_ignore(incoming, existing)
    assert rows(once) == [("A", 1.0), ("A", 3.0), (None, 2.0), (None, None)]
    assert rows(insert_ignore(incoming, once)) == rows(once)


def test_append_twice_is_append_once(spark, tmp_path):
    path = str(tmp_path / "table")
    schema = "airport string, fare double"
    spark.createDataFrame([("A", 1.0)], schema).write.parquet(path)
    incoming = spark.createDataFrame([("A", 1.0), ("B", None), ("B", None)], schema)
    for _ in range(2):
        append_unseen(spark, incoming, path)
        assert rows(spark.read.parquet(path)) == [("A", 1.0), ("B", None)]


def test_first_insert_makes_the_table(spark, tmp_path):
    path = str(tmp_path / "new")
    incoming = spark.createDataFrame([("A", 1.0), ("A", 1.0), (None, None)], "airport string, fare double")
    append_unseen(spark, incoming, path)
    append_unseen(spark, incoming, path)
    assert rows(spark.read.parquet(path)) == [("A", 1.0), (None, None)]


def test_jdbc_column_types(spark):
    df = spark.createDataFrame([("A", 1.0, "t")], "a string, f double, b string")
    assert jdbc_column_types(df, 8) == "a VARCHAR(8), b VARCHAR(8)"
    assert jdbc_column_types(df.select("f")) == ""


def test_checkpoints_go_to_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint.shared_dir(spark) == configured
    kept = checkpoint.stored(spark.range(3))
    assert kept.count() == 3 and all(configured in f for f in kept.inputFiles())


def test_without_a_folder_the_warehouse_is_used():
    class Session:
        conf = {"spark.sql.warehouse.dir": "s3://bucket/warehouse"}

    assert checkpoint.shared_dir(Session) == "s3://bucket/warehouse/_intermediate"


DATA = "/root/testdata/sf0.001"


def test_derived_columns_do_not_depend_on_what_else_is_asked_for(spark):
    full = tables.itineraries(spark, DATA)
    for name in tables.COLUMNS[1:]:
        alone = tables.itineraries(spark, DATA, ["leg_id", name])
        assert rows(alone) == rows(full.select("leg_id", name)), name


def test_selected_legs_and_dates(spark):
    full = tables.itineraries(spark, DATA)
    some = tables.itineraries(spark, DATA, legs=[2, 3])
    assert rows(some) == rows(full.where("num_legs in (2, 3)"))
    span = (date(2000, 5, 1), date(2000, 9, 1))
    some = tables.itineraries(spark, DATA, dates=span)
    assert rows(some) == rows(filters.departing(full, *span))
    some = tables.itineraries(spark, DATA, start="N05")
    assert rows(some) == rows(full.where("starting_airport = 'N05'"))
    some = tables.itineraries(spark, DATA, dates=span, start="N05")
    assert rows(some) == rows(filters.departing(full, *span).where("starting_airport = 'N05'"))


def test_segment_column_alone(spark):
    one = tables.itineraries(spark, DATA, ["leg_id", "segments_cabin_code"])
    assert one.count() == 1473
