"""Times of segments and the layovers between them.

A segment's times are local date-times with the offset of their airport, as text. They become local times and
instants, both without a session's time zone in it. A segment meets the next one of its itinerary
where their lists are, so nothing is shuffled.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfare.functions.constants import TIME_OFFSET
from skyfare.functions.expr import segment_list

DEPARTURES, ARRIVALS = "segments_departure_time_raw", "segments_arrival_time_raw"


def _offset_text(text: Column) -> Column:
    return F.regexp_extract(text, TIME_OFFSET, 1)


def local_time(text: Column) -> Column:
    """The date and time of a text, as the clock at the airport shows it; NULL if it is none or has no time."""
    clock = F.left(text, F.length(text) - F.length(_offset_text(text)))
    return F.when(text.rlike("[T ]"), clock.try_cast("timestamp_ntz"))


def offset_minutes(text: Column) -> Column:
    """How far a text says its clock is ahead of UTC; NULL if it does not say."""
    offset = _offset_text(text)
    digits = F.replace(F.substr(offset, F.lit(2)), F.lit(":"), F.lit(""))
    minutes = F.substr(digits, F.lit(1), F.lit(2)).try_cast("int") * 60 + F.substr(digits, F.lit(3)).try_cast("int")
    signed = F.when(offset.startswith("-"), -minutes).otherwise(minutes)
    return F.when(offset == "Z", F.lit(0)).when(offset != "", signed)


def time_at(text: Column) -> Column:
    """local, offset_minutes, utc and epoch seconds of a text; without an offset it counts as UTC."""
    local, ahead = local_time(text), offset_minutes(text)
    utc = local - F.make_dt_interval(F.lit(0), F.lit(0), F.coalesce(ahead, F.lit(0)))
    clock = F.hour(utc) * 3600 + F.minute(utc) * 60 + F.second(utc)
    epoch = F.unix_date(utc.cast("date")).cast("bigint") * 86400 + clock
    return F.struct(local.alias("local"), ahead.alias("offset_minutes"), utc.alias("utc"), epoch.alias("epoch"))


def segment_times(df: DataFrame) -> DataFrame:
    """One row per segment: its times, and its layover, which ends with the departure of the next segment.

    layover_minutes: from landing to leaving again, full minutes; NULL after the last segment, and where a time is missing.
    overnight_stop: the next segment leaves on a later day by the clocks of the airport. Lists of
    different lengths are filled up with NULL, a missing list is an empty one.
    """
    empty = F.array().cast("array<string>")
    zipped = F.arrays_zip(
        F.coalesce(segment_list(DEPARTURES), empty).alias("departs"), F.coalesce(segment_list(ARRIVALS), empty).alias("arrives")
    )
    rows = df.select("leg_id", zipped.alias("texts"))
    rows = rows.select("leg_id", "texts", F.posexplode("texts").alias("pos", "text"))
    # Texts are parsed when they are rows, in compiled code; the next segment's departure comes along as text.
    rows = rows.select("leg_id", "pos", "text.departs", "text.arrives", F.get("texts", F.col("pos") + 1)["departs"].alias("follows"))
    rows = rows.select("leg_id", "pos", *[time_at(F.col(c)).alias(c) for c in ("departs", "arrives", "follows")])
    return rows.select(
        "leg_id",
        (F.col("pos") + 1).alias("segment_no"),
        *[F.col(f"{side}.{f}").alias(f"{name}_{f}") for side, name in (("departs", "departure"), ("arrives", "arrival")) for f in ("local", "offset_minutes", "utc", "epoch")],
        F.floor((F.col("follows.epoch") - F.col("arrives.epoch")) / 60).alias("layover_minutes"),
        (F.col("follows.local").cast("date") > F.col("arrives.local").cast("date")).alias("overnight_stop"),
    )


def layovers(segments: DataFrame) -> DataFrame:
    """Per itinerary: stops, the longest layover, all of them together, and nights spent at an airport."""
    waits = F.col("layover_minutes")
    return segments.groupBy("leg_id").agg(
        F.count(waits).alias("stops"),
        F.max(waits).alias("longest_layover"),
        F.sum(waits).alias("layover_minutes"),
        F.count_if("overnight_stop").alias("overnight_stops"),
    )
