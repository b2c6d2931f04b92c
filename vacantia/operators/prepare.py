"""Listing projections: the columns every view is computed from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.dims import NEW_DAYS
from vacantia.functions import dates, places, text, urls


def hay() -> Column:
    """Search text of a listing: every word that a query may start."""
    names = F.transform("states", lambda s: places.state_name(s, default=F.lit("")))
    return text.word_text(
        F.concat_ws(
            " ",
            F.col("company"),
            F.col("role"),
            F.col("location"),
            F.col("category"),
            F.array_join(names, " "),
            F.when(F.col("remote"), F.lit("remote")).otherwise(F.lit("")),
        )
    )


def with_defaults(listings: DataFrame) -> DataFrame:
    """Absent flags read as false, absent states as none.

    For rows as they come in. The stored table holds no nulls here, which keeps its filters
    plain enough to reach the scan.
    """
    flags = {c: F.coalesce(c, F.lit(False)) for c in ("remote", "clearance", "closed")}
    none = F.array().cast("array<string>")
    return listings.withColumns({"states": F.coalesce("states", none), **flags})


def prepare(listings: DataFrame, as_of: str) -> DataFrame:
    """Adds slug, age and search text to stored listings."""
    return listings.withColumns(
        {
            "slug": text.slug(F.col("category")),
            "age": dates.age_days(F.col("date_added"), as_of),
            "hay": hay(),
        }
    )


def is_new(new_days: int = NEW_DAYS) -> Column:
    return ~F.col("closed") & (F.col("age") <= new_days)


def locations(listings: DataFrame) -> DataFrame:
    """Splits the location text into its parts, the one shown first and the overflow count."""
    split = listings.withColumn("locations", places.location_list(F.col("location")))
    return split.withColumns(
        {
            "primary": places.primary(F.col("location"), F.col("locations")),
            "n_more": places.overflow(F.col("locations")),
        }
    )


def explode_places(listings: DataFrame, column: str = "locations") -> DataFrame:
    """Listing x place bridge. A listing without a place keeps one row with a null.

    Duplicates can only sit inside one listing's own list, so they are dropped there
    and the bridge needs no shuffle.
    """
    return listings.select("id", F.explode_outer(F.array_distinct(column)).alias("place"))


def safe_links(listings: DataFrame) -> DataFrame:
    return listings.withColumn("url", urls.safe_url(F.col("url")))


def trusted_links(postings: DataFrame, employers: DataFrame, vendor_domains: DataFrame) -> DataFrame:
    """Keeps a board's own apply link only on the vendor's domain or a listed host.

    Any other link falls back to the vendor's page for that job. ``vendor_domains`` has
    one row per platform: the domain and the address the job's id is appended to.
    """
    hosts = employers.select("platform", "board_key", "apply_hosts")
    joined = postings.join(hosts, ["platform", "board_key"], "left")
    return link_or_page(joined, vendor_domains).drop("apply_hosts")


def link_or_page(postings: DataFrame, vendor_domains: DataFrame) -> DataFrame:
    """``trusted`` and ``link`` of postings that carry their board's ``apply_hosts``.

    A platform without a row in ``vendor_domains`` has no page to fall back to: its links stay.
    """
    joined = postings.join(vendor_domains, "platform", "left")
    host = urls.host(F.col("url"))
    on_vendor = (host == F.col("domain")) | F.endswith(
        host, F.concat(F.lit("."), F.col("domain"))
    )
    listed = F.array_contains("apply_hosts", host)
    trusted = F.coalesce(on_vendor, F.lit(False)) | F.coalesce(listed, F.lit(False))
    fallback = F.concat_ws("/", F.col("job_page"), F.col("board_key"), F.col("posting_id"))
    return joined.withColumns(
        {
            "trusted": trusted,
            "link": F.when(trusted | F.col("job_page").isNull(), F.col("url")).otherwise(fallback),
        }
    ).drop("domain", "job_page")
