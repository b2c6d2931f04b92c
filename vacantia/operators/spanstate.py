"""Stored state of the lifecycle: what a run needs to know of all sightings before it.

The state holds segments: a listing's sightings as stretches of days (first, last) in which no two
neighbours are more than ``STEP`` days apart. No closing lies inside a segment, and the closings, returns, spans and
absences that follow from all sightings follow from the segments and the boards' scan days. Segments of two sets
of sightings joined are the segments of all of them, in whatever order they came, so a day that lands late
restates just what it changes.

Segments are stored by the month of their last day. A run over landed sightings reads the partitions that such a
sighting can touch, which for days in order is this month and the last, merges them in one shuffle and replaces them
under the table's version pointer.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacantia.functions import dates
from vacantia.operators import lifecycle, versions

#: Days between two sightings of a segment at most. One, so that every gap there was can be told.
STEP = 1

SEGMENT = T.StructType(
    [
        T.StructField("listing_id", T.StringType()),
        T.StructField("board", T.StringType()),
        T.StructField("first", T.DateType()),
        T.StructField("last", T.DateType()),
    ]
)
SCAN_DAY = T.StructType([T.StructField("board", T.StringType()), T.StructField("day", T.DateType())])


def segments(seen: DataFrame) -> DataFrame:
    """Each sighting as a segment of its own; ``merge`` joins them."""
    return seen.select("listing_id", "board", F.col("day").alias("first"), F.col("day").alias("last"))


def merge(parts: DataFrame) -> DataFrame:
    """Segments that overlap or are at most ``STEP`` days apart become one.

    A listing has at most one row per day, so a window is as long as the calendar.
    """
    own = Window.partitionBy("listing_id", "board")
    before = own.orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    until = F.max("last").over(before)
    opens = until.isNull() | (F.datediff("first", until) > STEP)
    numbered = parts.withColumn("opens", opens.cast("int")).withColumn(
        "island", F.sum("opens").over(own.orderBy("first", "last").rowsBetween(Window.unboundedPreceding, 0))
    )
    return numbered.groupBy("listing_id", "board", "island").agg(
        F.min("first").alias("first"), F.max("last").alias("last")
    ).drop("island")


def gaps(parts: DataFrame, scan_days: DataFrame, as_of: str, grace: DataFrame) -> DataFrame:
    """Each segment with the next one and its closing day, as ``lifecycle.gaps`` has it for each sighting.

    ``day`` is the segment's last day; ``as_of`` is not before any sighting.
    """
    return lifecycle.closings(_followed(parts).withColumnRenamed("last", "day"), scan_days, as_of, grace)


def _followed(parts: DataFrame) -> DataFrame:
    following = Window.partitionBy("listing_id").orderBy("first", "last")
    return parts.withColumn("next_day", F.lead("first").over(following))


def spans(gap_rows: DataFrame) -> DataFrame:
    """First seen, last seen, last reopened and, if closed now, the closing day."""
    reopened = F.when(F.col("closed_on").isNotNull(), F.col("next_day"))
    return gap_rows.groupBy("listing_id").agg(
        F.min("first").alias("first_seen"),
        F.max("day").alias("last_seen"),
        F.max(reopened).alias("last_reopened"),
        F.max_by("closed_on", "day").alias("closed_date"),
    )


def _month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def landed_days(seen: DataFrame) -> list[datetime.date]:
    """The days that rows name; as many as the calendar has."""
    return sorted(r["day"] for r in seen.where("day IS NOT NULL").select("day").distinct().collect())


def touched(version: versions.Version, days: list[datetime.date]) -> list[str]:
    """Partitions whose segments a sighting on one of the days can join or follow."""
    if not days:
        return []
    least = (days[0] - datetime.timedelta(STEP)).strftime("%Y-%m")
    return sorted(p for p in version.runs if p >= least)


def fold_sightings(spark: SparkSession, path: str, seen: DataFrame) -> versions.Version:
    """Merges landed sightings (listing_id, board, day) into the stored segments and commits them.

    The same rows landing again change nothing.
    """
    base = versions.current(spark, path)
    known = seen.where("listing_id IS NOT NULL AND day IS NOT NULL")
    parts = touched(base, landed_days(known))
    held = versions.read(spark, path, SEGMENT, base, parts)
    joined = merge(held.unionByName(segments(known).distinct()))
    return versions.commit(joined, path, _month(F.col("last")), base, parts)


def fold_scan_days(spark: SparkSession, path: str, done: DataFrame) -> versions.Version:
    """Adds landed days of successful scans (board, day), stored by month."""
    base = versions.current(spark, path)
    known = done.where("board IS NOT NULL AND day IS NOT NULL").select("board", "day")
    parts = sorted({d.strftime("%Y-%m") for d in landed_days(known)})
    held = versions.read(spark, path, SCAN_DAY, base, [p for p in parts if p in base.runs])
    return versions.commit(held.unionByName(known).distinct(), path, _month(F.col("day")), base, parts)


def fold(spark: SparkSession, path: str, log: DataFrame) -> None:
    """One run over landed scan rows (listing_id, board, day, scan_ok): segments and scan days.

    Rows without a listing mark a scan that read nothing.
    """
    ok = log.where("scan_ok")
    fold_scan_days(spark, f"{path}/scan_days", ok)
    fold_sightings(spark, f"{path}/segments", ok.select("listing_id", "board", "day"))


def read(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Segments and scan days as last committed."""
    return (
        versions.read(spark, f"{path}/segments", SEGMENT), versions.read(spark, f"{path}/scan_days", SCAN_DAY)
    )


def lifecycle_rows(spark: SparkSession, path: str, as_of: str, grace: DataFrame) -> DataFrame:
    """The gap rows of the stored state."""
    parts, days = read(spark, path)
    return gaps(parts, days, as_of, grace)


def absence(parts: DataFrame, scan_days: DataFrame, as_of: str) -> DataFrame:
    """What ``lifecycle.absence`` says, from the state."""
    last_scan = scan_days.where(F.col("day") <= dates.day(as_of)).groupBy("board").agg(F.max("day").alias("last_scan"))
    inside = F.when(F.col("first") < F.col("last"), F.lit(STEP)).otherwise(F.lit(0))
    per = _followed(parts).groupBy("listing_id").agg(
        F.max_by("board", "last").alias("board"), F.max("last").alias("last_seen"),
        F.max(F.greatest(inside, F.coalesce(F.datediff("next_day", "last"), F.lit(0)))).alias("longest_gap"),
    )
    return per.join(last_scan, "board", "left").select(
        "listing_id", "board", "last_seen", "last_scan", "longest_gap",
        F.greatest(F.lit(0), F.datediff("last_scan", "last_seen")).alias("absent_days"),
    )


def changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Spans that a run made (``before`` null), restated or left as they were not, by listing."""
    old, new = (f.select("listing_id", F.struct("first_seen", "last_seen", "last_reopened", "closed_date").alias(n))
                for f, n in ((before, "was"), (after, "is")))
    both = old.join(new, "listing_id", "full")
    return both.where(~F.col("was").eqNullSafe(F.col("is")))
