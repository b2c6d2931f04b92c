"""Predicates over prepared listings and the composed board view."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions import dates, text
from vacantia.operators import sorts


@dataclass(frozen=True)
class View:
    """One state of the board's controls."""

    type: str = "intern"
    q: str = ""
    cat: tuple[str, ...] = ()
    state: str = ""
    days: str = ""
    noclear: bool = False
    closed: bool = False
    sort: str = ""


def of_type(kind: str) -> Column:
    return F.col("type") == kind


def open_only() -> Column:
    return ~F.col("closed")


def no_clearance() -> Column:
    return ~F.col("clearance")


def in_place(place: str) -> Column:
    return F.col("remote") if place == "remote" else F.array_contains("states", place)


def added_within(days: int, as_of: str) -> Column:
    """Age of at most ``days``, stated on the stored date so that the scan can skip by it."""
    return F.col("date_added") >= F.date_sub(dates.day(as_of), days)


def in_categories(slugs: tuple[str, ...] | list[str]) -> Column:
    return F.col("slug").isin(list(slugs)) if slugs else F.lit(True)


def search(query: str) -> Column:
    """Every word of the query must start some word of the search text.

    Long words come first: they match least, so most rows need one test.
    """
    words = sorted(set(text.query_words(query)), key=lambda w: (-len(w), w))
    return _all([F.col("hay").contains(f" {w}") for w in words])


def search_column(query: Column, hay: Column) -> Column:
    """The same test for a query held in a column."""
    return F.forall(text.words(query), lambda w: F.contains(hay, F.concat(F.lit(" "), w)))


def _all(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def passes(view: View, as_of: str) -> Column:
    """Every filter but type and category, cheap ones first."""
    parts = []
    if not view.closed:
        parts.append(open_only())
    if view.noclear:
        parts.append(no_clearance())
    if view.state:
        parts.append(in_place(view.state))
    if view.days:
        parts.append(added_within(int(view.days), as_of))
    if text.query_words(view.q):
        parts.append(search(view.q))
    return _all(parts)


def matches(view: View, as_of: str) -> Column:
    return of_type(view.type) & passes(view, as_of) & in_categories(view.cat)


def hide(listings: DataFrame, applied: DataFrame | None) -> DataFrame:
    """Rows whose id is not in ``applied`` (listing_id); all rows if there is none."""
    if applied is None:
        return listings
    return listings.join(applied.select(F.col("listing_id").alias("id")), "id", "left_anti")


def board_view(
    listings: DataFrame, view: View, as_of: str, applied: DataFrame | None = None
) -> DataFrame:
    """The rows a view shows, in display order. ``applied`` holds ids to hide."""
    shown = hide(listings.where(matches(view, as_of)), applied)
    return sorts.company_a_to_z(shown) if view.sort == "company" else sorts.newest_first(shown)
