"""Cutting smaller extracts out of the itinerary table."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfare.functions.constants import EXTRACT_COLUMNS, SAMPLE_STEP
from skyfare.operators.position import Positions, with_preceding

#: Order of the rows unless another is given; ties go by the other columns.
ORDER = ("flight_date", "leg_id")


def extract_columns(df: DataFrame, without: tuple[str, ...] = ()) -> DataFrame:
    """The extract's columns. Those a table is known not to have are named in ``without``."""
    wanted = [c for c in EXTRACT_COLUMNS if c not in without]
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {', '.join(missing)}")
    return df.select(wanted)


def drop_index_column(df: DataFrame, name: str = "Unnamed: 0") -> DataFrame:
    """Drop a stray index column; no effect when there is none."""
    return df.drop(name)


def systematic_sample(
    df: DataFrame,
    order: tuple[str, ...] = ORDER,
    step: int = SAMPLE_STEP,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Rows 0, step, 2*step, ... in the order of some columns, NULL first.

    ``keys`` may be a cheaper frame of the order columns alone, if they tell all rows apart and are not NULL; positions
    are then taken there, and only sampled rows are looked at as a whole.
    """
    placed = with_preceding(df if keys is None else keys, list(order), {"rows": F.lit(1)}, keys is not None)
    sample = placed.where(F.col("rows_before") % step == 0).drop("rows_before")
    return sample if keys is None else df.join(sample.select(*order), list(order), "left_semi")


def text_bytes(df: DataFrame) -> Column:
    """Size of a row as text, without separators."""
    sizes = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns]
    return sum(sizes[1:], sizes[0]).cast("bigint")


def size_capped_extract(
    df: DataFrame, budget: int, order: tuple[str, ...] = ORDER, unique: bool = False
) -> DataFrame:
    """The first rows in order, taken while the bytes before a row are within ``budget``.

    Rows of buckets past the cap are left out before any are sorted.
    """
    positions = Positions(df, list(order), {"bytes": text_bytes(df)}, unique)
    near = positions.totals().where(F.col("bytes_ahead") <= budget)
    return positions.rows(near).where(F.col("bytes_before") <= budget).drop("bytes_before")


def size_capped_chunks(
    df: DataFrame, budget: int, chunk_rows: int, order: tuple[str, ...] = ORDER, unique: bool = False
) -> DataFrame:
    """The same in whole chunks of ``chunk_rows``: a chunk is taken while the bytes
    before it are within ``budget``, so the result runs over by up to one chunk.
    """
    positions = Positions(df, list(order), {"bytes": text_bytes(df), "rows": F.lit(1)}, unique)
    totals = positions.totals()
    # the last chunk starts in a bucket within the budget and ends at most this far on
    within = totals.where(F.col("bytes_ahead") <= budget)
    reach = within.agg(F.max(F.col("rows_ahead") + F.col("rows")) + chunk_rows).scalar()
    rows = positions.rows(totals.where(F.col("rows_ahead") < reach))
    chunk = Window.partitionBy(F.floor(F.col("rows_before") / chunk_rows))
    rows = rows.withColumn("chunk_bytes", F.min("bytes_before").over(chunk))
    return rows.where(F.col("chunk_bytes") <= budget).drop("bytes_before", "rows_before", "chunk_bytes")
