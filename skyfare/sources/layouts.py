"""CSV files read by their own headers.

A scan takes one header for all its files. Here the first line of every file is looked at, files of equal
headers make one scan with that header as its schema, and the scans are appended by column name. A column
that a file does not have is NULL there. Only first lines come to the driver; a header counts
as many bytes as it has, and there are as many scans as different headers.
"""

import csv
from collections import Counter
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfare.sources.files import first_line

#: First lines read at the same time.
READERS = 16


def csv_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """The files of paths, folders and patterns."""
    return sorted(unquote(f) for f in spark.read.text(path).inputFiles())


def parsed_header(line: str, renamed: Mapping[str, str] = {}) -> tuple[str, ...]:
    """Column names of a header line. A column without name, such as a stray index, is named by its place."""
    cells = next(csv.reader([line.removeprefix("﻿")]))
    return tuple(renamed.get(c, c) or f"_c{i}" for i, c in enumerate(cells))


def layouts(spark: SparkSession, path: str | list[str], renamed: Mapping[str, str] = {}) -> dict[tuple[str, ...], list[str]]:
    """Header -> the files that have it. A header that names a column twice is an error; empty files are left out."""
    files = csv_files(spark, path)
    with ThreadPoolExecutor(max_workers=READERS) as pool:
        lines = list(pool.map(lambda f: first_line(spark, f), files))
    found: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, lines):
        if line is not None:
            found.setdefault(parsed_header(line, renamed), []).append(file)
    for header, named in found.items():
        twice = [c for c, n in Counter(header).items() if n > 1]
        if twice:
            raise ValueError(f"{named[0]}: column named twice: {', '.join(twice)}")
    if not found:
        raise ValueError(f"no file with a header in {path}")
    return found


def read_by_header(
    spark: SparkSession,
    path: str | list[str],
    renamed: Mapping[str, str] = {},
    known: set[str] | None = None,
    record: str | None = None,
) -> DataFrame:
    """The rows of CSV files, every column a text, by the names in each file's header.

    ``renamed``: other spellings of column names. ``known``: a file without any of these columns is an
    error, as its first line is hardly a header. ``record``: a column for the text of rows whose cells do not match their
    header; it comes with ``<record> cells``, how many there should be, and makes the scan read all columns.
    """
    found = layouts(spark, path, renamed)
    odd = [files[0] for header, files in found.items() if known is not None and not known & set(header)]
    if odd:
        raise ValueError(f"no known column in the first line of {', '.join(odd)}")

    def scan(header: tuple[str, ...], files: list[str]) -> DataFrame:
        names = [*header, record] if record else header
        schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in names)
        reader = spark.read.schema(schema).options(header=True, quote='"', escape='"')
        if record is None:
            return reader.csv(files)
        checked = reader.options(columnNameOfCorruptRecord=record, columnPruning=False).csv(files)
        # A scan for the text of records alone is not allowed: it goes with the first column.
        text = F.when(F.col(record).isNotNull(), F.coalesce(record, F.col(f"`{header[0].replace('`', '``')}`")))
        return checked.withColumn(record, text).select("*", F.lit(len(header)).alias(f"{record} cells"), F.col("_metadata.file_path").alias("source_file"))

    scans = [scan(header, files) for header, files in sorted(found.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
