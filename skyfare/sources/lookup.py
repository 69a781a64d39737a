"""Stored tables in which the rows of a key are found without a scan.

Rows lie in folders by a hash of their key and are sorted by it. The hash of the values that are looked up is a constant
of the plan, so one folder is listed and read, and in it the row groups that can hold the key.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = "key_bucket"


def _bucket(values: list[Column], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*values), F.lit(buckets)).cast("int")


def write_lookup(df: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    """Stores ``df`` for lookups by all of ``keys``; a key with many rows is one folder, in several files if need be."""
    rows = df.withColumn(BUCKET, _bucket([F.col(k) for k in keys], buckets))
    rows = rows.hint("rebalance", F.col(BUCKET)).sortWithinPartitions(BUCKET, *keys)
    rows.write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def lookup(spark: SparkSession, path: str, buckets: int, **values: object) -> DataFrame:
    """The rows whose keys have these values, in the order of keys in which the table was written; None is NULL."""
    rows = spark.read.parquet(path)
    found = {k: F.lit(v).cast(dict(rows.dtypes)[k]) for k, v in values.items()}
    rows = rows.where(F.col(BUCKET) == _bucket(list(found.values()), buckets))
    for k, v in found.items():
        rows = rows.where(F.col(k).isNull() if values[k] is None else F.col(k) == v)
    return rows.drop(BUCKET)
