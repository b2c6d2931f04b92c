"""Distinct counts that merge: a sketch per key and day, added up for any span of days.

An exact distinct count over a span reads all its rows again. The sketches of a day are a few kilobytes
whatever its rows, are kept, and a span or a coarser key is the union of those it covers. Rows that land
late, or twice, are folded into their day's sketch: a value that is already in it changes nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Binary logarithm of a sketch's buckets.
LG_BUCKETS = 12


def standard_error(lg_buckets: int = LG_BUCKETS) -> float:
    """Relative standard error of an estimate, an upper bound for the sketch's two estimators."""
    return 1.04 / math.sqrt(1 << lg_buckets)


def day_sketches(
    rows: DataFrame, value: str, day: str, keys: tuple[str, ...] = (), lg_buckets: int = LG_BUCKETS
) -> DataFrame:
    """(keys, day, sketch) of the different values of each key and day; null values count for nothing."""
    return rows.groupBy(*keys, F.col(day).alias("day")).agg(F.hll_sketch_agg(value, F.lit(lg_buckets)).alias("sketch"))


def fold(stored: DataFrame, landed: DataFrame) -> DataFrame:
    """The stored sketches with those of newly landed rows in them, which have the same columns."""
    keys = [c for c in stored.columns if c != "sketch"]
    return stored.unionByName(landed).groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimates(sketches: DataFrame, keys: tuple[str, ...] = (), during: Column | None = None) -> DataFrame:
    """(keys, estimate): different values per key over the days for which ``during`` holds, all by default.

    Keys may be fewer than the sketches have. A key without a day in the span has no row; without keys there
    is one row, of 0 if there is no day.
    """
    kept = sketches if during is None else sketches.where(during)
    return kept.groupBy(*keys).agg(
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0)).alias("estimate")
    )


def close_to(estimate: Column, exact: Column, lg_buckets: int = LG_BUCKETS, errors: float = 4.0) -> Column:
    """Whether an estimate is within so many standard errors of the exact count, or within one of it."""
    return F.abs(estimate - exact) <= F.greatest(F.lit(1.0), errors * standard_error(lg_buckets) * exact)
