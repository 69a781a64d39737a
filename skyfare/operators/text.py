"""Number and word warm-ups."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def squares_even(df: DataFrame, column: str) -> DataFrame:
    """Squares of a column that are even."""
    square = (F.col(column).cast("bigint") * F.col(column)).alias("square")
    return df.select(square).where(F.col("square") % 2 == 0)


def tokenize(df: DataFrame, key: str, text: str) -> DataFrame:
    """Every word of every text, split on single spaces; empty words are kept."""
    return df.select(key, F.explode(F.split(text, " ")).alias("word"))
