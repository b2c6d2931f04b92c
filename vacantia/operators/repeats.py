"""Repeat markers: does a row follow another of the same employer in display order?

A ``lag`` over a whole table would sort each table in one task. Rows of one employer
and day are neighbours, so it is enough to know the first row of each such group, found
by a partial aggregate, and what stands before the group. Groups are compared over the
calendar, never over rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vacantia.functions.text import ci


def _flag(listings: DataFrame, heads: DataFrame) -> DataFrame:
    """Rows that open no group are repeats; a head is one if it continues its employer.

    The join key is the unique id, so no employer or day can make it uneven.
    """
    heads = heads.select(F.col("first_id").alias("id"), "continues")
    joined = listings.join(heads, "id", "left")
    return joined.withColumn("is_repeat", F.coalesce("continues", F.lit(True))).drop("continues")


def newest_first(listings: DataFrame) -> DataFrame:
    """Markers under the default order, per type."""
    groups = listings.groupBy("type", "closed", "date_added", "company").agg(
        F.min("id").alias("first_id")
    )
    at = F.struct(ci(F.col("company")).alias("k"), F.col("company"), F.col("first_id"))
    blocks = groups.groupBy("type", "closed", "date_added").agg(
        F.min(at).alias("head"), F.max(at).alias("tail")
    )
    # One row per type, closed flag and day: as long as the calendar, whatever the data.
    before = Window.partitionBy("type").orderBy("closed", F.desc("date_added"))
    carried = blocks.withColumn("previous", F.lag("tail.company").over(before)).select(
        F.col("head.first_id").alias("first_id"),
        F.coalesce(F.col("previous") == F.col("head.company"), F.lit(False)).alias("carries"),
    )
    heads = groups.select("first_id").join(carried, "first_id", "left")
    return _flag(listings, heads.withColumn("continues", F.coalesce("carries", F.lit(False))))


def company_a_to_z(listings: DataFrame) -> DataFrame:
    """Markers under the company order, per type."""
    groups = listings.groupBy("type", "company", "date_added").agg(F.min("id").alias("first_id"))
    # One row per day and spelling of one employer.
    before = Window.partitionBy("type", ci(F.col("company"))).orderBy(
        F.desc("date_added"), "company"
    )
    same = F.lag("company").over(before) == F.col("company")
    return _flag(listings, groups.withColumn("continues", F.coalesce(same, F.lit(False))))


def published(listings: DataFrame, day: str = "date_added") -> DataFrame:
    """Markers of the published tables: same employer and same day as the row above."""
    groups = listings.groupBy("type", "closed", day, "company").agg(F.min("id").alias("first_id"))
    return _flag(listings, groups.withColumn("continues", F.lit(False)))
