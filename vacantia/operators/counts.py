"""Counts over the board: tabs, facets, summary, pulse, employers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.dims import NEW_DAYS, PULSE_DAYS, TABLE_RETENTION, TYPES
from vacantia.functions import dates, places
from vacantia.operators import filters
from vacantia.operators.filters import View


def _per_type(condition: Column) -> list[Column]:
    return [F.count_if((F.col("type") == t) & condition).alias(t) for t in TYPES]


def _stack_types(wide: DataFrame) -> DataFrame:
    """One row of three counts to three rows, so an empty type keeps its zero."""
    pairs = F.array(*[F.struct(F.lit(t).alias("type"), F.col(t).alias("n")) for t in TYPES])
    return wide.select(F.explode(pairs).alias("r"), *[c for c in wide.columns if c not in TYPES]).select(
        "r.type", "r.n", *[c for c in wide.columns if c not in TYPES]
    )


def _matched(
    listings: DataFrame, view: View, as_of: str, applied: DataFrame | None
) -> DataFrame:
    """Rows of any type that pass every filter, without those in ``applied`` (listing_id)."""
    matched = filters.passes(view, as_of) & filters.in_categories(view.cat)
    return filters.hide(listings.where(matched), applied)


def tab_counts(
    listings: DataFrame, view: View, as_of: str, applied: DataFrame | None = None
) -> DataFrame:
    """Matches per type under all filters, hidden ids included, zeros kept."""
    return _stack_types(_matched(listings, view, as_of, applied).agg(*_per_type(F.lit(True))))


def facet_counts(
    listings: DataFrame, view: View, as_of: str, categories: list[str] | tuple[str, ...],
    applied: DataFrame | None = None,
) -> DataFrame:
    """Per category what ticking it alone would show in the active tab.

    Grouping every row and counting conditionally keeps categories with no match at
    zero and drops those absent from the data, in one scan; only ids to hide need a join.
    """
    hit = filters.of_type(view.type) & filters.passes(view, as_of)
    if applied is not None:
        listings = _with_hide(listings, applied)
        hit = hit & F.col("hide").isNull()
    counted = listings.groupBy("category", "slug").agg(F.count_if(hit).alias("n"))
    order = F.array_position(F.array(*[F.lit(c) for c in categories]), F.col("category"))
    known = counted.withColumn("ordinal", order.cast("int")).where("ordinal > 0")
    return known.orderBy("ordinal")


def _with_hide(listings: DataFrame, applied: DataFrame) -> DataFrame:
    """All rows, with ``hide`` set on those whose id is in ``applied`` (listing_id)."""
    hidden = applied.select(F.col("listing_id").alias("id"), F.lit(True).alias("hide")).distinct()
    return listings.join(hidden, "id", "left")


def shown_of_total(
    listings: DataFrame, view: View, as_of: str, applied: DataFrame | None = None
) -> DataFrame:
    """Rows shown, and rows of the tab under the closed rule alone.

    ``applied`` holds ids to hide; they still count in the total.
    """
    in_tab = filters.of_type(view.type)
    if not view.closed:
        in_tab = in_tab & filters.open_only()
    tab, shown = listings.where(in_tab), filters.matches(view, as_of)
    if applied is not None:
        tab, shown = _with_hide(tab, applied), shown & F.col("hide").isNull()
    return tab.agg(F.count_if(shown).alias("shown"), F.count(F.lit(1)).alias("total"))


def other_tab_hint(
    listings: DataFrame, view: View, as_of: str, applied: DataFrame | None = None
) -> DataFrame:
    """Types with matches to offer when the active tab shows nothing."""
    wide = _matched(listings, view, as_of, applied).agg(*_per_type(F.lit(True)))
    empty = wide.where(F.col(view.type) == 0)
    return _stack_types(empty).where("n > 0")


def summary(listings: DataFrame, new_days: int = NEW_DAYS) -> DataFrame:
    """Open rows, new rows and employers with open rows.

    Counting per employer first makes the distinct count a plain row count.
    """
    per_company = (
        listings.where(~F.col("closed"))
        .groupBy("company")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("age") <= new_days).alias("fresh"))
    )
    return per_company.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("open_rows"),
        F.coalesce(F.sum("fresh"), F.lit(0)).alias("new_rows"),
        F.count(F.lit(1)).alias("companies"),
    )


def headline(listings: DataFrame, as_of: str, new_days: int = NEW_DAYS) -> DataFrame:
    """The headline figures in one conditional aggregate."""
    return listings.where(~F.col("closed")).agg(
        *_per_type(F.lit(True)),
        F.count_if(F.col("age") <= new_days).alias("new_rows"),
        F.count_if("clearance").alias("clearance_rows"),
        F.lit(as_of).alias("updated"),
    )


def pulse(listings: DataFrame, as_of: str, days: int = PULSE_DAYS) -> DataFrame:
    """Open rows per day added, one row for each of the last ``days`` days."""
    counted = (
        listings.where(~F.col("closed") & (F.col("age") < days))
        .groupBy("age")
        .agg(F.count(F.lit(1)).alias("found"))
    )
    spark = listings.sparkSession
    calendar = spark.range(days).select(F.col("id").cast("int").alias("age"))
    return calendar.join(counted, "age", "left").select(
        F.date_sub(dates.day(as_of), F.col("age")).alias("day"),
        "age",
        F.coalesce("found", F.lit(0)).alias("n"),
    )


def pulse_peak(pulse_rows: DataFrame, new_days: int = NEW_DAYS) -> DataFrame:
    """Highest bar (at least 1, the latest day wins a tie), total, and whether it is recent."""
    top = F.max(F.struct("n", "day", "age"))
    return pulse_rows.agg(top.alias("top"), F.sum("n").alias("total")).select(
        F.greatest(F.lit(1), F.col("top.n")).alias("peak"),
        F.when(F.col("top.n") > 0, F.col("top.day")).alias("peak_day"),
        "total",
        ((F.col("top.n") > 0) & (F.col("top.age") <= new_days)).alias("recent"),
    )


def hiring_pivot(listings: DataFrame) -> DataFrame:
    """Employer x type counts of open rows, zeros left blank."""
    wide = listings.where(~F.col("closed")).groupBy("company").agg(*_per_type(F.lit(True)))
    return wide.select("company", *[F.nullif(F.col(t), F.lit(0)).alias(t) for t in TYPES])


def boards_per_platform(employers: DataFrame) -> DataFrame:
    """Distinct employers per platform and, with a null platform, over all."""
    named = employers.select("platform", "name").distinct()
    return named.rollup("platform").agg(F.countDistinct("name").alias("employers"))


def closed_counts(listings: DataFrame, as_of: str, days: int = TABLE_RETENTION) -> DataFrame:
    recent = F.datediff(dates.day(as_of), F.col("closed_date")) <= days
    wide = listings.where(F.col("closed") & recent).agg(*_per_type(F.lit(True)))
    return _stack_types(wide)


def place_options(listings: DataFrame) -> DataFrame:
    """States named by any row, with their display names, in name order."""
    codes = listings.select(F.explode("states").alias("code")).distinct()
    named = codes.withColumn("name", places.state_name(F.col("code")))
    return named.orderBy("name", "code")


def board_yield(postings: DataFrame, scans: DataFrame | None = None) -> DataFrame:
    """Postings read and kept per board and scan day.

    ``scans`` holds (board_key, scan_date) of the scans that were due; one that landed
    nothing has a row of zeros.
    """
    landed = postings.groupBy("board_key", "scan_date").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("kept").alias("kept")
    )
    if scans is None:
        return landed
    due = scans.select("board_key", "scan_date").distinct()
    return due.join(landed, ["board_key", "scan_date"], "full").na.fill(0, ["n", "kept"])


def verdict_counts(judged: DataFrame) -> DataFrame:
    return judged.groupBy("verdict", "reason").agg(F.count(F.lit(1)).alias("n"))
