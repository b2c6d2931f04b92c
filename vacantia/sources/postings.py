"""Landed posting dumps of the job-board platforms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.dims import SEARCHED_PLATFORMS
from vacantia.functions import text

# The searches run on boards that cannot be read whole.
DEFAULT_TERMS = ("cyber", "cloud", "student")


def union_postings(dumps: dict[str, tuple[DataFrame, dict[str, str]]]) -> DataFrame:
    """One posting table from dumps of different shape.

    Each platform brings its rows and a mapping from the common column names to its own
    column expressions; a column it lacks is null.
    """
    shaped = [
        rows.selectExpr(*[f"{own} AS {name}" for name, own in columns.items()]).withColumn(
            "platform", F.lit(platform)
        )
        for platform, (rows, columns) in dumps.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), shaped)


def prune_by_terms(
    postings: DataFrame, employers: DataFrame, hay: Column, terms: tuple[str, ...] = DEFAULT_TERMS
) -> DataFrame:
    """What the searches return: rows with a common term or one of the employer's own.

    Platforms that are read whole pass untouched.
    """
    own = employers.select("platform", "board_key", "search_terms")
    joined = postings.join(own, ["platform", "board_key"], "left")
    return joined.where(found_by_terms(hay, terms)).drop("search_terms")


def found_by_terms(hay: Column, terms: tuple[str, ...] = DEFAULT_TERMS) -> Column:
    """Does a posting with its board's ``search_terms`` come up? Terms are read as words, like the text."""
    common = [" ".join(text.query_words(t)) for t in terms]
    own = F.transform(
        F.coalesce("search_terms", F.array().cast("array<string>")),
        lambda t: F.array_join(text.words(t), " "),
    )
    named = [F.contains(hay, F.lit(t)) for t in common if t]
    found = F.exists(own, lambda t: (t != "") & F.contains(hay, t))
    return ~F.col("platform").isin(*SEARCHED_PLATFORMS) | reduce(lambda a, b: a | b, named, found)
