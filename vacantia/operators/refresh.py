"""One scan from landed postings to the stored table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacantia.dims import BOARDLESS, TABLE_RETENTION
from vacantia.functions import dates
from vacantia.functions.text import word_text
from vacantia.operators import lifecycle, prepare, sets, versions
from vacantia.rules.classify import classify
from vacantia.session import stored as stored_rows
from vacantia.sources.postings import DEFAULT_TERMS, found_by_terms


def board_rows(
    postings: DataFrame,
    employers: DataFrame,
    vendor_domains: DataFrame,
    as_of: str,
    terms: tuple[str, ...] = DEFAULT_TERMS,
) -> DataFrame:
    """Postings that the rules let in, as listing rows, each id once.

    Postings of boards that are not configured fall away, but for the platforms that are one
    employer without boards. Boards are joined once, before the rules, and every rule is a column, so
    the scan is one pass over the postings unless the employer table is too large to broadcast. Only
    the rows let in, without their texts, are shuffled to find repeated ones; of those the least by
    title and link stays.
    """
    boards = employers.select(
        "platform", "board_key", F.col("name").alias("company"), F.col("security_company").alias("sec_co"),
        "search_terms", "apply_hosts",
    )
    landed = postings.drop("company", "sec_co", "search_terms", "apply_hosts")
    known = landed.join(boards, ["platform", "board_key"], "left")
    for platform, name in BOARDLESS.items():
        own = F.when(F.col("platform") == platform, F.lit(name))
        known = known.withColumn("company", F.coalesce("company", own))
    known = known.where("company IS NOT NULL").withColumn("sec_co", F.coalesce("sec_co", F.lit(False)))
    found = known.where(found_by_terms(word_text(F.col("title")), terms))
    judged = classify(found, as_of).where("verdict = 'in'")
    rows = prepare.link_or_page(judged, vendor_domains).select(
        F.concat_ws("/", "platform", "board_key", "posting_id").alias("id"),
        "platform", "board_key", "company",
        F.col("title").alias("role"),
        "type", "category",
        F.array_join("us_locations", "; ").alias("location"),
        F.col("us_locations").alias("locations"),
        F.col("us_states").alias("states"),
        F.col("us_remote").alias("remote"),
        F.col("needs_clearance").alias("clearance"),
        F.col("link").alias("url"),
        dates.day(as_of).alias("date_added"),
        F.lit(False).alias("closed"),
        F.lit(None).cast("date").alias("closed_date"),
        F.lit(None).cast("date").alias("reopened_date"),
        F.lit("board").alias("source"),
    )
    row = F.struct("role", "url", *[c for c in rows.columns if c not in ("id", "role", "url")])
    return rows.groupBy("id").agg(F.min(row).alias("row")).select("id", "row.*")


def merge_scan(scraped: DataFrame, community: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of both sources that the stored table does not hold yet."""
    return sets.new_rows(sets.union_sources(scraped, community), stored)


def update_table(
    stored: DataFrame,
    found: DataFrame,
    seen: DataFrame,
    closers: dict[str, DataFrame],
    as_of: str,
    final: tuple[str, ...] = ("expired",),
    days: int = TABLE_RETENTION,
) -> DataFrame:
    """The stored table after a scan: new rows in, rows closed and reopened, old closed rows out.

    ``found`` are the rows of the scan (see ``board_rows``), ``seen`` the sightings so far, ``closers``
    the closings by reason. A stored closing before a listing's last sighting is undone, and so is a
    claim to close it, unless its reason is one of ``final``: a sighting proves that the board is read again,
    but does not renew a term. A second run over the same inputs changes nothing.
    """
    new = sets.new_rows(found, stored)
    rows = stored.unionByName(new, allowMissingColumns=True).withColumnRenamed("id", "listing_id")
    if "reason" not in rows.columns:
        rows = rows.withColumn("reason", F.lit(None).cast("string"))
    shut = rows.where("closed").select("listing_id", F.col("closed_date").alias("shut"), "reason")
    back = (
        seen.join(shut, "listing_id")
        .where((F.col("day") > F.col("shut")) & ~F.coalesce(F.col("reason").isin(*final), F.lit(False)))
        .groupBy("listing_id").agg(F.min("day").alias("back"))
    )
    again = F.col("back").isNotNull()
    opened = rows.join(back, "listing_id", "left").withColumns(
        {
            "closed": F.col("closed") & ~again,
            "closed_date": F.when(~again, F.col("closed_date")),
            "reason": F.when(~again, F.col("reason")),
            "reopened_date": F.coalesce("back", "reopened_date"),
        }
    ).drop("back")
    last = seen.groupBy("listing_id").agg(F.max("day").alias("last_seen"))
    holding = {
        reason: claims if reason in final else claims.join(last, "listing_id", "left").where(
            F.col("last_seen").isNull() | (F.col("closed_date") >= F.col("last_seen"))
        ).drop("last_seen")
        for reason, claims in closers.items()
    }
    resolved = lifecycle.resolve_lifecycle(opened, holding).withColumnRenamed("listing_id", "id")
    return lifecycle.retain_closed(resolved, as_of, days)


def commit_update(
    spark: SparkSession, path: str, schema: T.StructType, part: Column, update: Callable[[DataFrame], DataFrame]
) -> versions.Version:
    """Replaces the stored table in ``path`` by what ``update`` makes of it, partition by partition.

    Only partitions with a row that is new, gone or changed are written, and the version moves once all of
    them are. An update that changes nothing commits nothing, so a run may be repeated. ``part`` is the
    partition that a row belongs to; no column is a map.
    """
    base = versions.current(spark, path)
    held = versions.read(spark, path, schema, base)
    after = stored_rows(update(held).select(schema.names), "updated")
    changed = _signed(held, part, -1).unionByName(_signed(after, part, 1)).groupBy("_row", "_part").agg(
        F.sum("_n").alias("_n")
    ).where("_n <> 0")
    parts = [r["_part"] for r in changed.select("_part").distinct().collect()]
    if not parts:
        return base
    return versions.commit(after.where(part.cast("string").isin(parts)), path, part, base, parts)


def _signed(rows: DataFrame, part: Column, n: int) -> DataFrame:
    """A row's digest, which tells null from every value, its partition and a sign."""
    row = F.sha2(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "true"}), 256)
    return rows.select(row.alias("_row"), part.cast("string").alias("_part"), F.lit(n).alias("_n"))
