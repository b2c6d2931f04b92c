"""Set operations between sources, scans and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_sources(scraped: DataFrame, community: DataFrame) -> DataFrame:
    return scraped.withColumn("source", F.lit("board")).unionByName(
        community.withColumn("source", F.lit("community")), allowMissingColumns=True
    )


def new_rows(scan: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of a scan that the stored table does not know."""
    return scan.join(stored.select("id"), "id", "left_anti")


def known_only(selected: Column, known: Column) -> Column:
    """Selected values that still exist, each once."""
    return F.array_intersect(selected, known)


def run_diff(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Rows a change flips between two judged runs.

    Both runs hold ``key, verdict, type, category``; rows alike in both drop out.
    """
    old = before.select(key, F.struct("verdict", "type", "category").alias("old"))
    new = after.select(key, F.struct("verdict", "type", "category").alias("new"))
    joined = old.join(new, key, "full_outer")
    changed = joined.where(~F.col("old").eqNullSafe(F.col("new")))
    move = (
        F.when(F.col("old").isNull(), F.lit("added"))
        .when(F.col("new").isNull(), F.lit("removed"))
        .when(
            ~F.col("old.verdict").eqNullSafe(F.col("new.verdict")),
            F.concat_ws("->", F.col("old.verdict"), F.col("new.verdict")),
        )
        .when(~F.col("old.type").eqNullSafe(F.col("new.type")), F.lit("type"))
        .otherwise(F.lit("category"))
    )
    return changed.withColumn("move", move)
