"""Readers and writers for the wide itinerary table."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfare.functions.constants import (
    AIRPORT_COLUMNS,
    PATH_COLUMNS,
    SOURCE_ALIASES,
    SOURCE_COLUMNS,
)
from skyfare.functions.expr import leg_count
from skyfare.sources.layouts import read_by_header

_TYPES = dict(SOURCE_COLUMNS.values())


def read_raw_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV with headers, every column a string; nothing is inferred from the rows.

    Each file is read by its own header: files may have other column orders, and may lack columns or
    have more. A file without any column of the source is an error.
    """
    return read_by_header(spark, path, SOURCE_ALIASES, set(SOURCE_COLUMNS))


def rename_source(raw: DataFrame) -> DataFrame:
    """Source names to engine names; unknown columns (a stray index) are left out."""
    picked = []
    for name in raw.columns:
        source = SOURCE_ALIASES.get(name, name)
        if source in SOURCE_COLUMNS:
            picked.append(F.col(f"`{name}`").alias(SOURCE_COLUMNS[source][0]))
    return raw.select(picked)


def type_columns(df: DataFrame) -> DataFrame:
    """Cast to the documented types. A cell that does not parse becomes NULL."""
    return df.select(
        [
            F.col(c) if _TYPES[c] == "string" else F.col(c).try_cast(_TYPES[c]).alias(c)
            for c in df.columns
        ]
    )


def with_num_legs(df: DataFrame) -> DataFrame:
    return df.withColumn("num_legs", leg_count("segments_airline_name"))


def read_itineraries_csv(
    spark: SparkSession, path: str | list[str], columns: list[str] | None = None
) -> DataFrame:
    """Typed itineraries from CSV. ``columns`` are engine names; the scan reads only those."""
    df = rename_source(read_raw_csv(spark, path))
    if columns is not None:
        missing = [c for c in columns if c not in df.columns]
        if missing:
            raise ValueError(f"no such columns: {', '.join(missing)}")
        df = df.select(columns)
    df = type_columns(df)
    return with_num_legs(df) if "segments_airline_name" in df.columns else df


def count_rejects(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row: per typed column, how many non-empty cells did not parse."""
    raw = rename_source(read_raw_csv(spark, path))
    return raw.agg(
        *[
            F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(_TYPES[c]).isNull()).alias(c)
            for c in raw.columns
            if _TYPES[c] != "string"
        ]
    )


def read_airports_csv(spark: SparkSession, path: str) -> DataFrame:
    """Airport dimension: code and position."""
    return _read_typed(spark, path, AIRPORT_COLUMNS)


def read_paths_csv(spark: SparkSession, path: str) -> DataFrame:
    """Flight paths: how often each was flown and where it starts and ends."""
    return _read_typed(spark, path, PATH_COLUMNS)


def _read_typed(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    raw = read_by_header(spark, path, known=set(columns))
    missing = [c for c in columns if c not in raw.columns]
    if missing:
        raise ValueError(f"no such columns: {', '.join(missing)}")
    return raw.select([F.col(c).try_cast(t).alias(c) for c, t in columns.items()])


def write_csv(df: DataFrame, path: str) -> None:
    """Header, no index column."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_lake(df: DataFrame, path: str) -> None:
    """Parquet partitioned by flight month, as a number like 202206.

    The rebalance hint sizes the files: small months share a task and a month that
    holds much of the data is split over several. Rows are sorted by route within a
    file, so a filter on an airport skips row groups.
    """
    month = F.year("flight_date") * 100 + F.month("flight_date")
    (
        df.withColumn("flight_month", month)
        .hint("rebalance", F.col("flight_month"))
        .sortWithinPartitions("flight_month", "starting_airport", "destination_airport")
        .write.mode("overwrite")
        .partitionBy("flight_month")
        .parquet(path)
    )


def read_lake(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def chunk_union(*chunks: DataFrame) -> DataFrame:
    """Append chunks of one schema, keeping every copy."""
    return reduce(DataFrame.unionByName, chunks)
