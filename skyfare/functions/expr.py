"""Column expressions shared by the operators. All are built-ins, no Python runs per row."""

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyfare.functions.constants import (
    DURATION,
    LAYOVER_CHEAPER,
    LAYOVER_DEARER,
    MISSING_TEXT,
    SEGMENT_SEPARATOR,
)

def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(total: Column, n: Column) -> Column:
    """``total / n`` as a double; NULL for an empty group, also in ANSI mode."""
    return total.cast("double") / F.nullif(n.cast("double"), F.lit(0.0))


def exact_avg(c: Column | str) -> Column:
    """Average whose sum is exact, so it does not depend on row order or partitioning."""
    c = _col(c)
    return ratio(F.sum(c), F.count(c))


def fare_text(c: Column | str) -> Column:
    """Money for display: two decimals, half-even, thousands commas."""
    return F.format_number(_col(c), 2)


def plain_text(c: Column | str) -> Column:
    """A number to two decimals, without commas; missing values are spelled out."""
    return F.coalesce(_col(c).cast("decimal(18,2)").cast("string"), F.lit(MISSING_TEXT))


def leg_count(airlines: Column | str) -> Column:
    """Number of legs in a segment list.

    Agrees with the three leg patterns: a list with separators and a stray single
    bar matches none of them and gives NULL, as does a NULL list.
    """
    c = _col(airlines)
    rest = F.replace(c, F.lit(SEGMENT_SEPARATOR), F.lit(""))
    pairs = ((F.length(c) - F.length(rest)) / len(SEGMENT_SEPARATOR)).cast("int")
    return (
        F.when(~c.contains(SEGMENT_SEPARATOR), F.lit(1))
        .when(rest.contains("|"), F.lit(None).cast("int"))
        .otherwise(pairs + 1)
    )


def segment_list(c: Column | str) -> Column:
    return F.split(_col(c), r"\|\|")


def duration_minutes(c: Column | str) -> Column:
    """Minutes of a ``P#DT#H#M`` text with optional parts; NULL when it is not one.

    One pattern checks the whole text; the parts are then cut out by position. A number of
    minutes that no bigint holds is NULL as well.
    """
    c = _col(c)
    time = F.when(c.contains("T"), F.substring_index(c, "T", -1)).otherwise("")

    def number(present: Column, text: Column, minutes: int) -> Column:
        value = F.try_multiply(text.try_cast("bigint"), F.lit(minutes).cast("bigint"))
        return F.when(present, value).otherwise(F.lit(0).cast("bigint"))

    days = number(c.contains("D"), F.substr(F.substring_index(c, "D", 1), F.lit(2)), 1440)
    hours = number(time.contains("H"), F.substring_index(time, "H", 1), 60)
    minutes = number(
        time.endswith("M"), F.substring_index(F.substring_index(time, "M", 1), "H", -1), 1
    )
    return F.when(c.rlike(DURATION), F.try_add(F.try_add(days, hours), minutes))


def layover_label(difference: Column | str) -> Column:
    """NULL takes the second branch."""
    return F.when(_col(difference) >= 0, F.lit(LAYOVER_CHEAPER)).otherwise(F.lit(LAYOVER_DEARER))


def month_start(year: int, month: int) -> date:
    """First day of a month; months past December roll over."""
    return date(year + (month - 1) // 12, (month - 1) % 12 + 1, 1)


def in_date_range(c: Column | str, first: date, end: date) -> Column:
    """``first <= c < end`` with literals: reaches the scan as a range filter."""
    c = _col(c)
    return (c >= F.lit(first)) & (c < F.lit(end))


def in_season(c: Column | str, year: int, months: list[int]) -> Column:
    """Dates in the given months of one year.

    ``month()`` and ``year()`` cannot be pushed to a scan, so the span of the
    months is added as a range; ``month()`` is kept only when the span has gaps.
    """
    c = _col(c)
    first, last = min(months), max(months)
    span = in_date_range(c, month_start(year, first), month_start(year, last + 1))
    gaps = set(range(first, last + 1)) - set(months)
    return span & F.month(c).isin(sorted(set(months))) if gaps else span
