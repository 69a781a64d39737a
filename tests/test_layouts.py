"""CSV files with headers of their own, and records that are refused."""

import gzip
from datetime import date
from decimal import Decimal

import pytest

from skyfare.sources import itineraries, layouts, quarantine
from tests.conftest import rows


def write(folder, name, *lines, newline="\n"):
    path = folder / name
    path.write_bytes((newline.join(lines) + newline).encode())
    return str(path)


def read(spark, path, columns=None):
    return itineraries.read_itineraries_csv(spark, path, columns)


def test_files_with_other_column_orders(spark, tmp_path):
    write(tmp_path, "a.csv", "legId,startingAirport,destinationAirport,baseFare", "1,BOS,JFK,10.5", "2,ATL,SFO,")
    write(tmp_path, "b.csv", "destinationAirport,startingAirport,legId,flightDate,note", "JFK,BOS,3,2022-04-17,x", '"S,FO",ATL,4,,"a ""b"""')
    write(tmp_path, "c d%.csv", "﻿,legId", "0,5")
    got = read(spark, str(tmp_path))
    assert set(got.columns) == {"leg_id", "starting_airport", "destination_airport", "base_fare", "flight_date"}
    order = ["leg_id", "starting_airport", "destination_airport", "base_fare", "flight_date"]
    assert rows(got.select(order)) == rows_of(
        ("1", "BOS", "JFK", Decimal("10.50"), None), ("2", "ATL", "SFO", None, None),
        ("3", "BOS", "JFK", None, date(2022, 4, 17)), ("4", "ATL", "S,FO", None, None), ("5", None, None, None, None),
    )
    # a chunk of the same schema is the same as a file of it
    parts = [read(spark, str(tmp_path / n), ["leg_id", "starting_airport"]) for n in ("a.csv", "b.csv")]
    assert rows(itineraries.chunk_union(*parts)) == rows(read(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], ["leg_id", "starting_airport"]))


def rows_of(*records):
    return sorted(records, key=repr)


def test_only_asked_columns_are_scanned(spark, tmp_path):
    write(tmp_path, "a.csv", "legId,startingAirport,baseFare", "1,BOS,10.5")
    write(tmp_path, "b.csv", "baseFare,legId", "2,2")
    df = read(spark, str(tmp_path), ["base_fare"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<baseFare:string>") == 2 and "startingAirport:string" not in plan


def test_compressed_empty_and_one_of_many_files(spark, tmp_path):
    (tmp_path / "a.csv.gz").write_bytes(gzip.compress(b"baseFare,legId\n7,1\n"))
    write(tmp_path, "b.csv", "legId,baseFare", "2,8", newline="\r\n")
    (tmp_path / "c.csv").write_bytes(b"")
    assert rows(read(spark, str(tmp_path), ["leg_id", "base_fare"])) == [("1", Decimal("7.00")), ("2", Decimal("8.00"))]
    found = layouts.layouts(spark, str(tmp_path))
    assert {h: len(f) for h, f in found.items()} == {("baseFare", "legId"): 1, ("legId", "baseFare"): 1}


def test_other_spellings_meet(spark, tmp_path):
    write(tmp_path, "a.csv", "legId,segmentsDepartureTimeEpochSecond", "1,10")
    write(tmp_path, "b.csv", "segmentsDepartureTimeEpochSeconds,legId", "20,2")
    assert rows(read(spark, str(tmp_path), ["leg_id", "segments_departure_time_epoch_seconds"])) == [("1", "10"), ("2", "20")]


def test_files_that_cannot_be_right_are_errors(spark, tmp_path):
    write(tmp_path, "a.csv", "legId,baseFare", "1,2")
    odd = write(tmp_path, "b.csv", "2,3", "4,5")
    with pytest.raises(ValueError, match="no known column.*b.csv"):
        read(spark, str(tmp_path))
    twice = write(tmp_path, "c.csv", "legId,legId", "4,5")
    with pytest.raises(ValueError, match="named twice: legId"):
        read(spark, twice)
    (tmp_path / "none").mkdir()
    with pytest.raises(ValueError, match="no file with a header"):
        read(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError, match="no such columns: flight_date"):
        read(spark, str(tmp_path / "a.csv"), ["flight_date"])
    with pytest.raises(ValueError, match="no such columns: long"):
        itineraries.read_airports_csv(spark, write(tmp_path, "d.csv", "iata,lat", "ATL,1"))
    assert odd


def test_dimension_files_of_two_layouts(spark, tmp_path):
    write(tmp_path, "a.csv", "iata,long,lat", "ATL,1,2")
    write(tmp_path, "b.csv", "lat,city,iata,long", "4,Boston,BOS,3")
    assert rows(itineraries.read_airports_csv(spark, str(tmp_path))) == [("ATL", 1.0, 2.0), ("BOS", 3.0, 4.0)]


DAMAGED = [
    "legId,flightDate,startingAirport,baseFare",
    "1,2022-04-17,BOS,10.5",
    "2,2022-04-17,BOS",
    "3,2022-04-17,BOS,10.5,more",
    '4,"2022-04-17,BOS,10.5',
    "5,2022-13-17,BOS,cheap",
    "6,,,",
    '7,2022-04-17,"B, ""O""",1',
    '8,2022-04-17,"a,b",1,2',
    '9,"a"',
]


def test_every_problem_has_a_reason(spark, tmp_path):
    write(tmp_path, "a.csv", *DAMAGED)
    write(tmp_path, "b.csv", "baseFare,legId", "x,10", "1,2,3", "5,11")
    df = quarantine.checked(spark, str(tmp_path))
    good = quarantine.accepted(df).select("leg_id", "starting_airport", "base_fare")
    assert rows(good) == rows_of(
        ("1", "BOS", Decimal("10.50")), ("6", None, None), ("7", 'B, "O"', Decimal("1.00")), ("11", None, Decimal("5.00"))
    )
    bad = quarantine.refused(df).selectExpr("substring_index(source_file, '/', -1)", "reason", "column_name", "cell")
    assert rows(bad) == rows_of(
        ("a.csv", "short record", None, DAMAGED[2]), ("a.csv", "long record", None, DAMAGED[3]),
        ("a.csv", "broken quote", None, DAMAGED[4]), ("a.csv", "bad cell", "flight_date", "2022-13-17"),
        ("a.csv", "bad cell", "base_fare", "cheap"), ("a.csv", "long record", None, DAMAGED[8]),
        ("a.csv", "short record", None, DAMAGED[9]),
        ("b.csv", "bad cell", "base_fare", "x"), ("b.csv", "long record", None, "1,2,3"),
    )


def test_ingest_writes_both_in_one_pass(spark, tmp_path):
    write(tmp_path, "a.csv", *DAMAGED)
    good, bad = quarantine.ingest(spark, str(tmp_path / "a.csv"), str(tmp_path / "stored"))
    df = quarantine.checked(spark, str(tmp_path / "a.csv"))
    assert rows(good) == rows(quarantine.accepted(df)) and rows(bad) == rows(quarantine.refused(df))
    for frame, kept in ((good, "true"), (bad, "false")):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "csv" not in plan.lower().replace("a.csv", "") and "PartitionFilters: [" in plan and kept
    counts = {(r.reason, r.column_name): r.num_problems for r in quarantine.refusals(bad).collect()}
    assert counts == {("short record", None): 2, ("long record", None): 2, ("broken quote", None): 1,
                      ("bad cell", "flight_date"): 1, ("bad cell", "base_fare"): 1}


def test_clean_and_header_only_files(spark, tmp_path):
    df = quarantine.checked(spark, write(tmp_path, "a.csv", "legId,segmentsAirlineName", "1,A||B"))
    assert rows(quarantine.accepted(df)) == [("1", "A||B", 2)] and quarantine.refused(df).collect() == []
    none = quarantine.checked(spark, write(tmp_path, "b.csv", "legId,baseFare"))
    assert none.collect() == []
