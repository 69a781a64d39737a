"""Builds that become current in one step, updates by month, inserts that grow, lookups and checksums."""

import random
import re

import pytest
from pyspark.sql import functions as F

from skyfare.operators import inserts
from skyfare.plans import comparison, marts
from skyfare.sources import itineraries, lookup, tables, versions
from tests.conftest import rows

DATA = "/root/testdata/sf0.001"
RUN = {"year": 2000, "months": [6, 7, 8], "route": ("N05", "N11")}


@pytest.fixture(scope="module")
def df(spark):
    return tables.itineraries(spark, DATA)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_a_failed_build_changes_nothing(spark, df, tmp_path, monkeypatch):
    root = str(tmp_path)
    with pytest.raises(ValueError, match="nothing is built"):
        marts.read(spark, root, ["travel_distance"])
    marts.build(spark, df, root, **RUN)
    before = {n: rows(f) for n, f in marts.read(spark, root, ["travel_distance", "route_average"]).items()}
    number = versions._numbers(spark, root)
    write, seen = marts.result_tables, []

    def failing(*args):
        out = write(*args)
        # half of the tables are written, and readers go on as before
        bad = out["travel_distance"].withColumn("x", F.raise_error(F.lit("no room")).cast("int"))
        seen.append({n: rows(f) for n, f in marts.read(spark, root, before).items()})
        return out | {"travel_distance": bad}

    monkeypatch.setattr(marts, "result_tables", failing)
    with pytest.raises(Exception, match="no room"):
        marts.build(spark, df.where("starting_airport = 'N05'"), root, **RUN)
    assert seen == [before] and versions._numbers(spark, root) == number
    assert {n: rows(f) for n, f in marts.read(spark, root, before).items()} == before


def test_readers_keep_what_they_began_with(spark, df, tmp_path):
    root = str(tmp_path)
    first = marts.build(spark, df, root, **RUN)["travel_distance"]
    expected = rows(first)
    second = marts.build(spark, df.where("starting_airport = 'N05'"), root, **RUN)["travel_distance"]
    assert rows(first) == expected and len(rows(second)) == 1
    marts.build(spark, df, root, **RUN)
    assert len(versions._numbers(spark, root)) == 2  # the first has been removed
    assert rows(marts.read(spark, root, ["travel_distance"])["travel_distance"]) == expected


def test_two_builds_at_once_get_two_numbers(spark, tmp_path):
    root = str(tmp_path)
    folders = [versions.new_folder(root) for _ in range(2)]
    for f in folders:
        spark.range(3).write.parquet(f)
    assert [versions.publish(spark, root, f) for f in folders] == [1, 2]
    assert versions.current(spark, root) == folders[1]


@pytest.mark.parametrize("changed", [[200006, 200007], [marts.NO_MONTH, 199901]])
def test_update_equals_a_full_build(spark, df, tmp_path, changed):
    day = F.when(F.col("leg_id") % 30 != 0, F.col("flight_date"))
    full = df.withColumn("flight_date", day)
    itineraries.write_lake(full, f"{tmp_path}/lake")
    lake = itineraries.read_lake(spark, f"{tmp_path}/lake")
    old = full.where(~marts.flight_month().isin(changed)).unionByName(full.where(marts.flight_month().isin(changed)).limit(5))
    marts.build(spark, old, f"{tmp_path}/marts", **RUN)
    got = marts.update(spark, lake, f"{tmp_path}/marts", changed, **RUN)
    expected = marts.build(spark, full, f"{tmp_path}/full", **RUN)
    for name, frame in expected.items():
        assert marts.differences(frame, got[name]).count() == 0, name
    with pytest.raises(ValueError, match="nothing is built"):
        marts.update(spark, lake, f"{tmp_path}/none", changed, **RUN)


def test_update_reads_changed_months_only(spark, df, tmp_path, monkeypatch):
    itineraries.write_lake(df, f"{tmp_path}/lake")
    marts.build(spark, df, f"{tmp_path}/marts", **RUN)
    made, seen = marts._rollups, []

    def watched(rows_of):
        seen.append(plan(rows_of))
        return made(rows_of)

    monkeypatch.setattr(marts, "_rollups", watched)
    marts.update(spark, itineraries.read_lake(spark, f"{tmp_path}/lake"), f"{tmp_path}/marts", [200006], **RUN)
    assert re.search(r"PartitionFilters: \[isnotnull\(flight_month#\d+\), \(flight_month#\d+ = 200006\)\]", seen[0])


SCHEMA = "flight_date date, airport string, fare double"


def trips_of(spark, n, seed=1):
    r = random.Random(seed)
    days = [None, *(f"2022-{m:02d}-{d:02d}" for m in (1, 2, 7) for d in (1, 15))]
    data = [(r.choice(days), r.choice(["A", "B", "", None, "1:A"]), r.choice([1.0, 2.5, None])) for _ in range(n)]
    return spark.createDataFrame(data, "flight_date string, airport string, fare double").selectExpr("cast(flight_date as date) flight_date", "airport", "fare")


def test_inserts_by_month_equal_insert_ignore(spark, tmp_path):
    path, known = f"{tmp_path}/t", spark.createDataFrame([], SCHEMA)
    for seed in (1, 2, 2):
        new = trips_of(spark, 40, seed)
        inserts.append_by_month(spark, new, path)
        known = spark.createDataFrame(rows(inserts.insert_ignore(new, known)), SCHEMA)
        assert rows(inserts.read_by_month(spark, path)) == rows(known)


def test_untouched_months_are_not_read(spark, tmp_path):
    path = f"{tmp_path}/t"
    inserts.append_by_month(spark, trips_of(spark, 200), path)
    new = trips_of(spark, 50, 5).where("month(flight_date) = 2")
    fresh = inserts.unseen_by_month(spark, new, path)
    text = plan(fresh)
    assert "PartitionFilters: [isnotnull(insert_month" in text and "202202" in text and "202201" not in text
    read = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert "row_digest:string" in read
    inserts.append_by_month(spark, spark.createDataFrame([], SCHEMA), path)


def test_digests_tell_rows_apart(spark):
    data = [("a", "b"), ("ab", ""), ("", "ab"), (None, "ab"), ("ab", None), (None, None), ("-", "-"), ("1:a", None), ("a,1:b", "")]
    df = spark.createDataFrame(data, "x string, y string")
    assert df.select(inserts.row_digest(["x", "y"])).distinct().count() == len(data)


def test_lookups_read_one_folder(spark, tmp_path):
    path = f"{tmp_path}/fares"
    data = [(f"S{i % 7}" if i % 11 else None, f"D{i % 5}", float(i)) for i in range(200)]
    lookup.write_lookup(spark.createDataFrame(data, "s string, d string, fare double"), path, ["s", "d"], 16)
    for s, d in (("S3", "D2"), (None, "D0"), ("S9", "D9")):
        found = lookup.lookup(spark, path, 16, s=s, d=d)
        assert rows(found) == rows(spark.createDataFrame([r for r in data if r[:2] == (s, d)], "s string, d string, fare double"))
        assert len(found.inputFiles()) == len(spark.read.parquet(path).inputFiles())  # all are known,
        assert re.search(r"PartitionFilters: \[isnotnull\(key_bucket#\d+\), \(key_bucket#\d+ = \d+\)\]", plan(found))  # one is listed


def test_route_fares_of_a_build(spark, df, tmp_path):
    built = marts.build(spark, df, str(tmp_path), **RUN)
    both = built["two_leg_flights"].unionByName(built["three_leg_flights"])
    pairs = [tuple(r) for r in both.select("starting_airport", "destination_airport").distinct().collect()]
    for pair in pairs[:4]:
        expected = both.where((F.col("starting_airport") == pair[0]) & (F.col("destination_airport") == pair[1]))
        found = marts.route_fares(spark, str(tmp_path), *pair)
        assert rows(found) == rows(expected.select(found.columns))
        assert "EqualTo(starting_airport," in plan(found) and "key_bucket" in plan(found)


def test_checksums_do_not_depend_on_order(spark):
    df = trips_of(spark, 300)
    parts = rows(comparison.checksums(df, ["airport"]))
    assert rows(comparison.checksums(df.repartition(7).orderBy("fare"), ["airport"])) == parts
    twice = comparison.checksums(df.unionAll(df.limit(1)), ["airport"])
    assert rows(twice) != parts


@pytest.mark.parametrize("change", ["none", "copy", "lost", "part", "nulls"])
def test_differences_by_part(spark, change):
    data = rows(trips_of(spark, 200))
    other = list(data)
    if change == "copy":
        other.append(other[0])
    if change == "lost":
        other.pop(17)
    if change == "part":
        other = [r for r in other if r[1] != "B"]
    if change == "nulls":
        other = [(d, None if a == "" else a, f) for d, a, f in other]
    expected, found = (spark.createDataFrame(x, SCHEMA) for x in (data, other))
    got = comparison.differences_by_part(expected, found, ["airport"])
    assert rows(got) == rows(marts.differences(expected, found))
    assert bool(got.take(1)) == (change != "none")


def test_equal_tables_are_compared_without_moving_rows(spark, tmp_path):
    for n in "ab":
        trips_of(spark, 300).repartition(3).write.parquet(f"{tmp_path}/{n}")
    a, b = (spark.read.parquet(f"{tmp_path}/{n}") for n in "ab")
    text = plan(comparison.differing_parts(a, b, ["airport"]))
    for exchange in text.split("Exchange hashpartitioning")[1:]:
        assert "HashAggregate" in exchange.splitlines()[1]
    assert comparison.differences_by_part(a, b, ["airport"]).collect() == []
