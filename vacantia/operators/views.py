"""Shared and saved searches: parsing, canonical form, and matching against listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.dims import QUERY_CAP, TYPES
from vacantia.functions import places, text
from vacantia.functions.urls import query_param
from vacantia.operators import filters
from vacantia.session import stored


def normalize_views(links: DataFrame, slugs: Column, states: Column, query_cap: int = QUERY_CAP) -> DataFrame:
    """Shared links to view records: known values are kept, the rest reads as the default.

    A query keeps its first ``query_cap`` characters. ``slugs`` and ``states`` are array columns of what the data holds, as a rule scalar
    subqueries over the two small dimensions.
    """
    url = F.col("url")
    kind, place, days = (query_param(url, k) for k in ("type", "state", "days"))
    cats = F.split(query_param(url, "cat"), ",")
    allowed = F.concat("known_places", F.array(F.lit("remote")))
    known = links.withColumns({"known_slugs": slugs, "known_places": states})
    return known.select(
        "view_id",
        F.when(kind.isin(*TYPES), kind).otherwise(F.lit(TYPES[0])).alias("type"),
        F.substring(query_param(url, "q"), 1, query_cap).alias("q"),
        F.filter(cats, lambda c: F.array_contains("known_slugs", c)).alias("cat"),
        F.when(F.array_contains(allowed, place), place).otherwise(F.lit("")).alias("state"),
        F.when(days.isin("7", "30"), days).otherwise(F.lit("")).alias("days"),
        (query_param(url, "noclear") == "1").alias("noclear"),
        (query_param(url, "closed") == "1").alias("closed"),
        F.when(query_param(url, "sort") == "company", F.lit("company"))
        .otherwise(F.lit(""))
        .alias("sort"),
    )


def active_filters(hide_applied: Column | None = None) -> Column:
    """How many filters of a view are set; type, text and order do not count."""
    flags = [F.col("state") != "", F.col("days") != "", F.col("noclear"), F.col("closed")]
    if hide_applied is not None:
        flags.append(hide_applied)
    return sum((f.cast("int") for f in flags), F.size("cat"))


def canonical_view() -> Column:
    """Query string of a view without its default values."""
    q = places.strip(F.col("q"))
    text_part = F.replace(F.url_encode(q), F.lit("%2C"), F.lit(","))

    def part(name: str, value: Column, shown: Column) -> Column:
        return F.when(shown, F.concat(F.lit(f"{name}="), value))

    return F.concat_ws(
        "&",
        part("type", F.col("type"), F.col("type") != TYPES[0]),
        part("q", text_part, q != ""),
        part("cat", F.array_join("cat", ","), F.size("cat") > 0),
        part("state", F.col("state"), F.col("state") != ""),
        part("days", F.col("days"), F.col("days") != ""),
        part("noclear", F.lit("1"), F.col("noclear")),
        part("closed", F.lit("1"), F.col("closed")),
        part("sort", F.col("sort"), F.col("sort") != ""),
    )


def group_views(views: DataFrame) -> DataFrame:
    """How often each canonical view was shared."""
    return views.groupBy(canonical_view().alias("view")).agg(F.count(F.lit(1)).alias("n"))


#: Listings of one key that meet its searches in one slice.
SLICE_ROWS = 50_000

_SEARCH = ["type", "needles", "cat", "state", "days", "noclear", "closed"]


def _searches(views: DataFrame) -> DataFrame:
    return views.withColumn("cat", F.array_sort(F.array_distinct("cat"))).withColumn(
        "needles", F.array_sort(F.array_distinct(text.words(F.col("q"))))
    )


def distinct_searches(views: DataFrame) -> DataFrame:
    """One row per search, however many people saved it; the display order plays no part."""
    return _searches(views).groupBy(*_SEARCH).agg(
        F.min("view_id").alias("search_id"), F.count(F.lit(1)).alias("saved")
    )


def view_searches(views: DataFrame) -> DataFrame:
    """(view_id, search_id) of every stored view: the search whose matches are the view's."""
    ids = distinct_searches(views).select(*_SEARCH, "search_id")
    return _searches(views).join(ids, _SEARCH).select("view_id", "search_id")


def _options() -> Column:
    """The sets of join keys a search can be filed under, each of which every listing it shows has one key of.

    A word's first three letters, its categories, its place, or its type, which always serves.
    """
    words = F.transform(
        F.filter("needles", lambda w: F.length(w) >= 3), lambda w: F.array(F.concat(F.lit("w:"), F.substring(w, 1, 3)))
    )
    cats = F.transform("cat", lambda c: F.concat(F.lit("c:"), c))
    none = F.array().cast("array<array<string>>")
    return F.concat(
        words, F.when(F.size("cat") > 0, F.array(cats)).otherwise(none),
        F.when(F.col("state") != "", F.array(F.array(F.concat(F.lit("s:"), F.col("state"))))).otherwise(none),
        F.array(F.array(F.lit("t:"))),
    )


def _listing_keys() -> Column:
    """Every anchor a search matching this listing could have."""
    tokens = F.filter(F.split("hay", " "), lambda w: F.length(w) >= 3)
    starts = F.transform(tokens, lambda w: F.concat(F.lit("w:"), F.substring(w, 1, 3)))
    states = F.transform("states", lambda s: F.concat(F.lit("s:"), s))
    remote = F.when(F.col("remote"), F.array(F.lit("s:remote"))).otherwise(
        F.array().cast("array<string>")
    )
    own = F.array(F.lit("t:"), F.concat(F.lit("c:"), F.col("slug")))
    return F.array_distinct(F.concat(own, states, remote, starts))


def search_options(searches: DataFrame) -> DataFrame:
    """(search_id, type, option, key): the keys of each set that a search can be filed under."""
    asked = searches.select("search_id", "type", F.posexplode(_options()).alias("option", "keys"))
    return asked.select("search_id", "type", "option", F.explode("keys").alias("key"))


def file_searches(options: DataFrame, keys: DataFrame) -> DataFrame:
    """(search_id, type, key, n): each search under the set of keys that the fewest listings have.

    ``keys`` holds (type, key) of the listings. How many have a key is counted, not guessed: a word that every listing
    of a board has is no anchor, whatever its length. A set of several keys costs the sum of them.
    """
    held = keys.groupBy("type", "key").agg(F.count(F.lit(1)).alias("n"))
    costed = options.join(held, ["type", "key"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    sets = costed.groupBy("search_id", "type", "option").agg(
        F.sum("n").alias("cost"), F.collect_list(F.struct("key", "n")).alias("keys")
    )
    best = sets.groupBy("search_id", "type").agg(F.min_by("keys", F.struct("cost", "option")).alias("keys"))
    return best.select("search_id", "type", F.explode("keys").alias("k")).select("search_id", "type", "k.key", "k.n")


def saved_search_matches(
    views: DataFrame, listings: DataFrame, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """For each saved search every listing it shows; ``view_searches`` names each view's search.

    The predicate is not an equality, but each search has parts that are: it is filed under the rarest of
    them (see ``file_searches``) and meets the ids of the listings that have the key. Only those candidates are
    tested in full, for which a listing's row moves once and not once for each of its keys. A search's keys are of one kind and a
    listing holds each key once, so no pair comes out twice. The listings of a common key are cut into slices of about
    ``slice_rows`` by its count, and its searches, already one row per distinct search, meet each slice. A search without a
    filter shows every open listing of its type.
    """
    searches = stored(distinct_searches(views).drop("saved"), "searches")
    options = stored(search_options(searches), "search-options")
    # Only keys that some search could be filed under are kept, a few narrow rows for each listing.
    named = options.select("type", "key").distinct()
    every = listings.select("id", "type", F.explode(_listing_keys()).alias("key"))
    keys = stored(every.join(named, ["type", "key"]), "listing-keys")
    filed = stored(
        file_searches(options, keys).where("n > 0").withColumn("slices", F.ceil(F.col("n") / slice_rows)), "filed-searches"
    )
    wanted = filed.select("type", "key", "slices").distinct()
    held = keys.join(wanted, ["type", "key"]).withColumn("slice", F.pmod(F.xxhash64("id"), F.col("slices")))
    asked = filed.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)))
    candidates = held.join(asked.drop("n", "slices"), ["type", "key", "slice"]).select("id", "search_id")
    told = searches.select(
        "search_id", "needles", F.col("cat").alias("v_cat"), F.col("state").alias("v_state"),
        F.col("days").alias("v_days"), F.col("noclear").alias("v_noclear"), F.col("closed").alias("v_closed"),
    )
    hit = (
        (F.col("v_closed") | filters.open_only())
        & (~F.col("v_noclear") | filters.no_clearance())
        & ((F.col("v_days") == "") | (F.col("age") <= F.col("v_days").try_cast("int")))
        & (
            F.when(F.col("v_state") == "remote", F.col("remote")).otherwise(
                (F.col("v_state") == "") | F.array_contains("states", F.col("v_state"))
            )
        )
        & ((F.size("v_cat") == 0) | F.array_contains("v_cat", F.col("slug")))
        & F.forall("needles", lambda w: F.contains(F.col("hay"), F.concat(F.lit(" "), w)))
    )
    rows = listings.select("id", "closed", "clearance", "remote", "states", "age", "slug", "hay")
    return candidates.join(told, "search_id").join(rows, "id").where(hit).select("search_id", "id")
