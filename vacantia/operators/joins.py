"""Joins between listings, employers, marks and dimensions.

No side is hinted: Spark broadcasts a dimension whose measured size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, splitting hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.dims import CATEGORIES, STATE_NAMES
from vacantia.functions.text import slug, word_text
from vacantia.session import fixed_table


def with_board(postings: DataFrame, employers: DataFrame) -> DataFrame:
    """Board options of each posting; postings of unknown boards drop out."""
    return postings.join(employers, ["platform", "board_key"])


def hide_applied(listings: DataFrame, marks: DataFrame, user: int | Column) -> DataFrame:
    mine = marks.where(F.col("user_id") == user).select(F.col("listing_id").alias("id"))
    return listings.join(mine, "id", "left_anti")


def applied_only(listings: DataFrame, marks: DataFrame, user: int | Column) -> DataFrame:
    mine = marks.where(F.col("user_id") == user).select(F.col("listing_id").alias("id"))
    return listings.join(mine, "id", "left_semi")


def with_applied(listings: DataFrame, marks: DataFrame, user: int | Column) -> DataFrame:
    mine = (
        marks.where(F.col("user_id") == user)
        .select(F.col("listing_id").alias("id"), F.lit(True).alias("applied"))
        .distinct()
    )
    return listings.join(mine, "id", "left").withColumn(
        "applied", F.coalesce("applied", F.lit(False))
    )


def states(spark) -> DataFrame:
    return fixed_table(spark, list(STATE_NAMES.items()), "code, name")


def categories(spark) -> DataFrame:
    """The legend; what a category covers is a landed column of the caller's, if wanted."""
    dim = fixed_table(spark, [(i + 1, name) for i, name in enumerate(CATEGORIES)], "ordinal, category")
    return dim.withColumn("slug", slug(F.col("category")))


def with_state_names(bridge: DataFrame, names: DataFrame) -> DataFrame:
    """Display name of each place, the code itself where none is known."""
    return bridge.join(names, bridge["place"] == names["code"], "left").select(
        *bridge.columns, F.coalesce("name", "place").alias("place_name")
    )


def with_category_text(listings: DataFrame, dim: DataFrame) -> DataFrame:
    return listings.join(dim.select("category", "ordinal", "description"), "category", "left")


def scan_vs_stored(scan: DataFrame, stored: DataFrame) -> DataFrame:
    """Each id as new, kept or missing. Both sides hold an id at most once."""
    left = scan.select("id", F.lit(True).alias("seen"))
    right = stored.select("id", F.lit(True).alias("known"))
    status = (
        F.when(F.col("known").isNull(), F.lit("new"))
        .when(F.col("seen").isNull(), F.lit("missing"))
        .otherwise(F.lit("kept"))
    )
    return left.join(right, "id", "full_outer").select("id", status.alias("status"))


def untracked(listings: DataFrame, employers: DataFrame) -> DataFrame:
    """Listings whose employer left the dimension."""
    names = employers.select(F.col("name").alias("company"))
    return listings.join(names, "company", "left_anti")


def silent_boards(employers: DataFrame, postings: DataFrame) -> DataFrame:
    """Configured boards without a posting.

    Posting boards are made distinct first, so the join is dimension to dimension.
    """
    seen = postings.select("platform", "board_key").distinct()
    return employers.join(seen, ["platform", "board_key"], "left_anti")


def duplicate_key() -> list[Column]:
    """What makes two rows the same role: employer, title words, set of places."""
    places = F.array_join(F.array_sort(F.array_distinct("locations")), ";")
    return [
        F.col("company"),
        word_text(F.col("role")).alias("role_key"),
        places.alias("place_key"),
    ]


def duplicate_groups(listings: DataFrame) -> DataFrame:
    """Roles posted more than once, with the row to keep."""
    keyed = listings.select("id", *duplicate_key())
    counted = keyed.groupBy("company", "role_key", "place_key").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("keep_id")
    )
    return counted.where("n > 1")


def drop_duplicates(listings: DataFrame) -> DataFrame:
    """One row per role, the lowest id; joined back on that unique id."""
    keyed = listings.select("id", *duplicate_key())
    kept = keyed.groupBy("company", "role_key", "place_key").agg(F.min("id").alias("id"))
    return listings.join(kept.select("id"), "id", "left_semi")
