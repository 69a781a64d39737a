"""Global positions and running totals without a window over the rows as a whole.

Rows are dealt out by ranges of their order and sorted within them, which Spark does, and stored with their place. Totals
are summed per range, running totals are taken over these, and a row then looks at the rows of its own range
only. Rows are ordered by any columns, ties by the other columns, NULL first; rows that are equal in all
columns may take each other's place.

The only window without partitions is over totals of ranges, of which there are as many as the session
has shuffle partitions.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfare.sources.checkpoint import stored

#: A place is the number of its range and, in the lower bits, that of the row in it.
PLACE_BITS = 33


class Positions:
    """A frame in the order of ``order``, with weights to be summed up.

    ``unique``: no two rows agree in ``order``, which spares comparing the other columns.
    """

    def __init__(self, df: DataFrame, order: list[str], weights: dict[str, Column], unique: bool):
        self.columns, self.weights = df.columns, weights
        ties = [] if unique else [c for c in df.columns if c not in order]
        keys = [F.col(c) for c in [*order, *ties]]
        width = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        # Rows that are equal in all columns are still dealt to several ranges.
        rows = df if unique else df.withColumn("row of task", F.monotonically_increasing_id())
        keys += [] if unique else [F.col("row of task")]
        rows = rows.repartitionByRange(width, *keys).sortWithinPartitions(*keys).drop("row of task")
        self.rows_placed = stored(rows.withColumn("row place", F.monotonically_increasing_id()), "places")

    def _ranged(self) -> DataFrame:
        return self.rows_placed.withColumn("row range", F.shiftright("row place", PLACE_BITS))

    def totals(self) -> DataFrame:
        """Weights per range and, as ``<w>_ahead``, of all ranges before it."""
        sums = self._ranged().groupBy("row range").agg(*[F.sum(c).alias(w) for w, c in self.weights.items()])
        before = Window.orderBy("row range").rowsBetween(Window.unboundedPreceding, -1)
        return sums.select(
            "*", *[F.coalesce(F.sum(w).over(before), F.lit(0)).alias(f"{w}_ahead") for w in self.weights]
        ).withColumnRenamed("row range", "total of")

    def rows(self, totals: DataFrame) -> DataFrame:
        """The rows of the ranges in ``totals`` with ``<w>_before``, the weight of all rows before."""
        own = Window.partitionBy("row range").orderBy("row place").rowsBetween(Window.unboundedPreceding, -1)
        rows = self._ranged().join(totals.select("total of", *[f"{w}_ahead" for w in self.weights]), F.expr("`row range` = `total of`"))

        def within(name: str, weight: Column) -> Column:
            if name == "rows":  # a row's place says how many are before it
                return F.col("row place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
            return F.coalesce(F.sum(weight).over(own), F.lit(0))

        before = {w: F.col(f"{w}_ahead") + within(w, c) for w, c in self.weights.items()}
        return rows.select(*self.columns, *[c.alias(f"{w}_before") for w, c in before.items()])


def with_preceding(
    df: DataFrame, order: list[str], weights: dict[str, Column], unique: bool = False
) -> DataFrame:
    """Add ``<w>_before``: the total weight of all rows before each in ``order``. The weight ``rows`` is one for each."""
    positions = Positions(df, order, weights, unique)
    return positions.rows(positions.totals())
