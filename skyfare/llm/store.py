"""Intermediate results kept in the folder the cluster shares, and the session's shuffle width."""

from pyspark.sql import SparkSession

from skyfare.sources.checkpoint import stored

__all__ = ["partitions", "stored"]


def partitions(spark: SparkSession) -> int:
    """The session's shuffle width, by which callers size work to their data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
