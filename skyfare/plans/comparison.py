"""Comparing tables by checksums of their parts, and by rows only where those differ."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfare.plans.marts import differences
from skyfare.sources.checkpoint import stored


def _row_sums(columns: list[str]) -> list[Column]:
    """Sums of two hashes of a row, exact, so neither order nor partitioning matters. NULLs are hashed by their place."""
    parts = [c for name in columns for c in (F.col(f"`{name}`").isNull(), F.col(f"`{name}`"))]
    hashes = [F.xxhash64(*parts), F.xxhash64(F.lit("again"), *reversed(parts))]
    return [F.sum(h.cast("decimal(38,0)")).alias(f"sum_{i}") for i, h in enumerate(hashes)]


def checksums(df: DataFrame, by: list[str]) -> DataFrame:
    """Per part (``by``) its number of rows and two checksums of them, copies counted. Only these are shuffled."""
    return df.groupBy(*by).agg(F.count("*").alias("num_rows"), *_row_sums(sorted(df.columns)))


def differing_parts(expected: DataFrame, found: DataFrame, by: list[str]) -> DataFrame:
    """Parts whose rows are not the same in both; a part that one table lacks is among them."""
    sums = ["num_rows", "sum_0", "sum_1"]
    both = checksums(expected, by).withColumn("side", F.lit(1)).unionByName(checksums(found.select(*expected.columns), by).withColumn("side", F.lit(2)))
    grouped = both.groupBy(*by).agg(F.count("*").alias("sides"), *[F.count_distinct(c).alias(c) for c in sums])
    return grouped.where((F.col("sides") < 2) | F.greatest(*sums).__gt__(1)).select(*by)


def differences_by_part(expected: DataFrame, found: DataFrame, by: list[str]) -> DataFrame:
    """What ``marts.differences`` gives, rows being compared only in parts whose checksums differ.

    Equal tables are told to be equal without moving a row. Both tables are read twice where they differ, so they should be stored.
    """
    parts = stored(differing_parts(expected, found, by).withColumnsRenamed({c: f"part {c}" for c in by}), "differing-parts")
    if parts.isEmpty():
        return expected.limit(0).withColumn("side", F.lit("missing"))

    def within(df: DataFrame) -> DataFrame:
        same = [F.col(c).eqNullSafe(F.col(f"part {c}")) for c in by]
        return df.join(parts, same, "left_semi")

    return differences(within(expected), within(found))
