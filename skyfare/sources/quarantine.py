"""Itineraries from CSV with every problem of a record named, and what is refused kept apart.

One scan judges each record: a record whose cells do not match the header of its file is short, long or has
a broken quote; a cell that does not parse is bad. ``ingest`` writes accepted and refused records in
that one pass.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfare.functions.constants import SOURCE_ALIASES, SOURCE_COLUMNS
from skyfare.sources.itineraries import rename_source, with_num_legs
from skyfare.sources.layouts import read_by_header

#: Reasons, in the order in which a record is tested.
BROKEN_QUOTE, SHORT, LONG, MALFORMED, BAD_CELL = "broken quote", "short record", "long record", "malformed record", "bad cell"
RECORD, CELLS = "_record", "_record cells"
_TYPES = dict(SOURCE_COLUMNS.values())


def record_reason(record: Column, cells: Column) -> Column:
    """Why a record does not have ``cells`` cells."""
    outside = F.regexp_replace(record, '"([^"]|"")*"', "")
    found = F.length(outside) - F.length(F.replace(outside, F.lit(","), F.lit(""))) + 1
    return (
        F.when(outside.contains('"'), BROKEN_QUOTE)
        .when(found < cells, SHORT)
        .when(found > cells, LONG)
        .otherwise(MALFORMED)
    )


def _problem(reason: Column, column: str | None, cell: Column) -> Column:
    return F.struct(reason.alias("reason"), F.lit(column).cast("string").alias("column_name"), cell.alias("cell"))


def checked(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Typed itineraries with ``source_file`` and ``problems``, an array of (reason, column_name, cell).

    A record that does not match its file's header has one problem, whose cell is the record; its other
    columns tell nothing. Else there is a problem for each cell that has a text and does not parse.
    Records without problems are those to be used.
    """
    raw = read_by_header(spark, path, SOURCE_ALIASES, set(SOURCE_COLUMNS), RECORD)
    texts = rename_source(raw)
    typed = [c for c in texts.columns if _TYPES[c] != "string"]
    source = {engine: name for name, (engine, _) in SOURCE_COLUMNS.items()}

    def bad(column: str) -> Column:
        cell = F.col(f"`{source[column]}`")
        wrong = cell.isNotNull() & cell.try_cast(_TYPES[column]).isNull()
        return F.when(wrong, _problem(F.lit(BAD_CELL), column, cell))

    broken = F.array(_problem(record_reason(F.col(RECORD), F.col(CELLS)), None, F.col(RECORD)))
    cells = F.array_compact(F.array(*[bad(c) for c in typed])) if typed else F.array().cast("array<struct<reason:string,column_name:string,cell:string>>")
    problems = F.when(F.col(RECORD).isNotNull(), broken).otherwise(cells)
    named = [F.col(f"`{source[c]}`").alias(c) for c in texts.columns]
    rows = raw.select(*named, "source_file", problems.alias("problems"))
    rows = rows.select(*_typed(texts.columns), "source_file", "problems")
    return with_num_legs(rows) if "segments_airline_name" in rows.columns else rows


def _typed(columns: list[str]) -> list[Column]:
    return [F.col(c) if _TYPES[c] == "string" else F.col(c).try_cast(_TYPES[c]).alias(c) for c in columns]


def accepted(rows: DataFrame) -> DataFrame:
    """The records of ``checked`` without problems."""
    return rows.where(F.size("problems") == 0).drop("problems", "source_file")


def refused(rows: DataFrame) -> DataFrame:
    """(source_file, reason, column_name, cell): the problems of ``checked``, one row each."""
    return rows.select("source_file", F.explode("problems").alias("p")).select("source_file", "p.*")


def ingest(spark: SparkSession, path: str | list[str], root: str) -> tuple[DataFrame, DataFrame]:
    """Writes ``checked`` records under ``root`` in one pass; returns the accepted and the refused as stored.

    They are partitions of one table, so the CSV is scanned once and a reader of either does not touch the other.
    """
    rows = checked(spark, path).withColumn("is_accepted", F.size("problems") == 0)
    rows.write.mode("overwrite").partitionBy("is_accepted").parquet(root)
    stored = spark.read.schema(rows.schema).parquet(root)
    return accepted(stored.where("is_accepted").drop("is_accepted")), refused(stored.where("not is_accepted"))


def refusals(rows: DataFrame) -> DataFrame:
    """How many problems of each reason and column ``refused`` has, by file."""
    return rows.groupBy("source_file", "reason", "column_name").agg(F.count("*").alias("num_problems"))
