"""Set-append: adding rows to a table without repeating any."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfare.sources import files
from skyfare.sources.checkpoint import stored

#: Columns that a table of months has besides its own.
MONTH, DIGEST = "insert_month", "row_digest"


def unseen_rows(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Distinct incoming rows that the existing table does not hold; NULLs compare equal.

    One grouping over both tables: copies collapse before the shuffle, and there is no
    join whose key could be skewed.
    """
    columns = existing.columns
    tagged = incoming.select(*columns, F.lit(True).alias("fresh")).union(
        existing.select(*columns, F.lit(False).alias("fresh"))
    )
    return tagged.groupBy(*columns).agg(F.bool_and("fresh").alias("fresh")).where("fresh").drop(
        "fresh"
    )


def insert_ignore(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """The table after the insert. It holds no row twice, so this is the distinct union."""
    return existing.unionByName(incoming.select(*existing.columns)).distinct()


def append_unseen(spark: SparkSession, incoming: DataFrame, path: str) -> None:
    """Append to a parquet table the rows it does not hold yet; the first run makes the table.

    Existing files are only read, so running it again after a failure is safe.
    """
    try:
        fresh = unseen_rows(incoming, spark.read.parquet(path))
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        fresh = incoming.distinct()
    fresh.write.mode("append").parquet(path)


def row_digest(columns: list[str]) -> Column:
    """128 bits of a row's texts, with their lengths; a NULL is unlike any text."""
    texts = [F.col(f"`{c}`").cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.md5(F.concat_ws(",", *parts))


def unseen_by_month(spark: SparkSession, incoming: DataFrame, path: str, day: str = "flight_date") -> DataFrame:
    """Distinct incoming rows that a table of months (``append_by_month``) does not hold, with month and digest.

    Of the table only the digests of months that come in are read. The list of those months comes to the driver; there are
    as many as the rows' days span. Rows without a day are a month of their own.
    """
    month = F.coalesce(F.year(day) * 100 + F.month(day), F.lit(0))
    rows = incoming.withColumn(MONTH, month).withColumn(DIGEST, row_digest(incoming.columns)).dropDuplicates([MONTH, DIGEST])
    if not files.names(spark, path):
        return rows
    rows = stored(rows, "incoming")
    months = sorted(r[0] for r in rows.select(MONTH).distinct().collect())
    known = spark.read.schema(rows.schema).parquet(path).where(F.col(MONTH).isin(months)).select(MONTH, DIGEST)
    return rows.join(known, [MONTH, DIGEST], "left_anti")


def append_by_month(spark: SparkSession, incoming: DataFrame, path: str, day: str = "flight_date") -> None:
    """Append to a table kept by month the rows it does not hold yet; the first run makes the table.

    The work grows with what comes in and with the months it touches, not with the table. Existing files are only
    read, and rows become part of the table when the whole write is done, so it may be run again.
    """
    fresh = unseen_by_month(spark, incoming, path, day)
    fresh.hint("rebalance", F.col(MONTH)).write.mode("append").partitionBy(MONTH).parquet(path)


def read_by_month(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(MONTH, DIGEST)
