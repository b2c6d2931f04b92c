"""From word lists to columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pattern(words: list[str]) -> str:
    return f" (?:{'|'.join(words)}) "


def has(title: Column, words: list[str]) -> Column:
    """Does a normalised title hold one of the entries as whole words?"""
    return title.rlike(pattern(words))


def without(title: Column, words: list[str]) -> Column:
    return F.regexp_replace(title, pattern(words), " ")


def first_reason(**tests: Column) -> Column:
    """Name of the first test that holds, in the order given."""
    return F.coalesce(*[F.when(test, F.lit(name.replace("_", " "))) for name, test in tests.items()])
