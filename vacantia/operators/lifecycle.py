"""Opening, closing and reopening, as window queries over append-only logs.

Logs are first reduced to one row per listing and day, so every window below is as long
as the calendar, however many times a posting was seen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacantia.dims import COMMUNITY_EXPIRY, GRACE_DAYS, HARD_STREAK, SOFT_STREAK
from vacantia.functions import dates


def _by_day() -> Window:
    """Days of one listing. A sighting is (listing_id, board, day)."""
    return Window.partitionBy("listing_id").orderBy("day")


def sightings(log: DataFrame) -> DataFrame:
    """Days on which a listing was read. Failed scans prove nothing and are left out."""
    return log.where("scan_ok").select("listing_id", "board", "day").distinct()


def latest(log: DataFrame, order: list[str]) -> DataFrame:
    """The last observation of each listing, kept by a partial aggregate, not a sort."""
    row = F.struct(*[c for c in log.columns if c != "listing_id"])
    last = log.groupBy("listing_id").agg(F.max_by(row, F.struct(*order)).alias("row"))
    return last.select("listing_id", "row.*")


def first_seen(log: DataFrame) -> DataFrame:
    return log.groupBy("listing_id").agg(F.min("ts").alias("first_ts"))


def _next_scan(scan_days: DataFrame, as_of: str) -> DataFrame:
    """For each board and calendar day the first successful scan on or after it."""
    span = scan_days.groupBy("board").agg(F.min("day").alias("lo"))
    calendar = span.select(
        "board", F.explode(F.sequence("lo", dates.day(as_of))).alias("target")
    )
    ok = scan_days.select("board", F.col("day").alias("target"), F.col("day").alias("scan"))
    ahead = (
        Window.partitionBy("board")
        .orderBy("target")
        .rowsBetween(Window.currentRow, Window.unboundedFollowing)
    )
    return calendar.join(ok, ["board", "target"], "left").select(
        "board", "target", F.first("scan", ignorenulls=True).over(ahead).alias("scan")
    )


def gaps(seen: DataFrame, scan_days: DataFrame | None, as_of: str, grace: DataFrame) -> DataFrame:
    """Each sighting with the next one and, if the gap was long enough, its closing day.

    A gap closes the listing on the first successful scan at least ``grace`` days after
    the sighting that still comes before the next one. Without ``scan_days`` every
    calendar day counts as scanned. ``grace`` holds (board, grace); a board without a row
    there has the usual one.
    """
    rows = seen.where(F.col("day") <= dates.day(as_of)).withColumn(
        "next_day", F.lead("day").over(_by_day())
    )
    found = closings(rows, scan_days, as_of, grace)
    return found.select("listing_id", "board", "day", "next_day", "closed_on")


def closings(rows: DataFrame, scan_days: DataFrame | None, as_of: str, grace: DataFrame) -> DataFrame:
    """Rows (board, day, next_day) with ``closed_on``, the day an absence after ``day`` closes the listing."""
    own = rows.columns
    rows = rows.join(grace, "board", "left").withColumn(
        "target", F.date_add("day", F.coalesce("grace", F.lit(GRACE_DAYS)))
    )
    if scan_days is None:
        rows = rows.withColumn("scan", F.col("target"))
    else:
        done = scan_days.where(F.col("day") <= dates.day(as_of)).select("board", "day").distinct()
        rows = rows.join(_next_scan(done, as_of), ["board", "target"], "left")
    closes = (F.col("scan") <= dates.day(as_of)) & (
        F.col("next_day").isNull() | (F.col("scan") < F.col("next_day"))
    )
    return rows.select(*own, F.when(closes, F.col("scan")).alias("closed_on"))


def absence(seen: DataFrame, scan_days: DataFrame, as_of: str) -> DataFrame:
    """Days since last seen, up to the board's last successful scan, and the longest gap."""
    last_scan = (
        scan_days.where(F.col("day") <= dates.day(as_of))
        .groupBy("board")
        .agg(F.max("day").alias("last_scan"))
    )
    stepped = seen.withColumn("gap", F.datediff("day", F.lag("day").over(_by_day())))
    per = stepped.groupBy("listing_id").agg(
        F.max_by("board", "day").alias("board"),
        F.max("day").alias("last_seen"),
        F.coalesce(F.max("gap"), F.lit(0)).alias("longest_gap"),
    )
    return per.join(last_scan, "board", "left").select(
        "listing_id", "board", "last_seen", "last_scan", "longest_gap",
        F.greatest(F.lit(0), F.datediff("last_scan", "last_seen")).alias("absent_days"),
    )


def spans(gap_rows: DataFrame) -> DataFrame:
    """First seen, last seen, last reopened and, if closed now, the closing day."""
    reopened = F.when(F.col("closed_on").isNotNull(), F.col("next_day"))
    return gap_rows.groupBy("listing_id").agg(
        F.min("day").alias("first_seen"),
        F.max("day").alias("last_seen"),
        F.max(reopened).alias("last_reopened"),
        F.max_by("closed_on", "day").alias("closed_date"),
    )


def close_absent(gap_rows: DataFrame) -> DataFrame:
    """Listings closed now because their posting left the board."""
    return spans(gap_rows).where("closed_date IS NOT NULL").select("listing_id", "closed_date")


def reopen(gap_rows: DataFrame) -> DataFrame:
    """Every return of a closed listing."""
    back = F.col("closed_on").isNotNull() & F.col("next_day").isNotNull()
    return gap_rows.where(back).select(
        "listing_id", F.col("closed_on").alias("closed_date"),
        F.col("next_day").alias("reopened_date"),
    )


def probe_streak(probes: DataFrame) -> DataFrame:
    """Each failed check with its place in the run of failures and the soft ones so far.

    ``probes`` holds the last check per (listing_id, probe_date).
    """
    so_far = Window.partitionBy("listing_id").orderBy("probe_date")
    failed = F.col("outcome") != "ok"
    marked = probes.withColumn("island", F.count_if(~failed).over(so_far)).where(failed)
    run = Window.partitionBy("listing_id", "island").orderBy("probe_date")
    return marked.select(
        "listing_id", "probe_date", "outcome",
        F.row_number().over(run).alias("streak"),
        F.count_if(F.col("outcome") == "soft_gone").over(run).alias("soft"),
    )


def followed_by_link(listings: DataFrame) -> DataFrame:
    """Ids whose closing the link checks decide: what no scan of a board can match."""
    own = (
        (F.col("source") == "community")
        | (F.col("platform") == "amazon")
        | F.col("board_key").isNull()
    )
    return listings.where(own).select(F.col("id").alias("listing_id"))


def close_dead_links(
    probes: DataFrame, hard: int = HARD_STREAK, soft: int = SOFT_STREAK
) -> DataFrame:
    """First day on which a listing's link counts as gone; a later good check cancels it.

    A run of failures with a soft one in it needs the longer streak.
    """
    needed = F.when(F.col("soft") > 0, F.lit(soft)).otherwise(F.lit(hard))
    good = probes.where("outcome = 'ok'").groupBy("listing_id").agg(F.max("probe_date").alias("last_good"))
    due = probe_streak(probes).where(F.col("streak") >= needed).join(good, "listing_id", "left")
    due = due.where(F.col("last_good").isNull() | (F.col("probe_date") > F.col("last_good")))
    return due.groupBy("listing_id").agg(F.min("probe_date").alias("closed_date"))


def _expiry(days: int) -> Column:
    opened = F.greatest("date_added", F.coalesce("reopened_date", "date_added"))
    return F.date_add(opened, days)


def expire_community(
    listings: DataFrame, as_of: str, days: int = COMMUNITY_EXPIRY
) -> DataFrame:
    """Community rows whose term since they were added or last reopened is over."""
    due = listings.where((F.col("source") == "community") & (_expiry(days) <= dates.day(as_of)))
    return due.select(F.col("id").alias("listing_id"), _expiry(days).alias("closed_date"))


def close_untracked(listings: DataFrame, employers: DataFrame, as_of: str) -> DataFrame:
    """Open listings of employers that are no longer configured."""
    names = employers.select(F.col("name").alias("company"))
    gone = listings.where(~F.col("closed")).join(names, "company", "left_anti")
    return gone.select(F.col("id").alias("listing_id"), dates.day(as_of).alias("closed_date"))


def retain_closed(listings: DataFrame, as_of: str, days: int) -> DataFrame:
    """Open rows, and closed rows still inside the horizon."""
    recent = F.datediff(dates.day(as_of), F.col("closed_date")) <= days
    return listings.where(~F.col("closed") | F.coalesce(recent, F.lit(False)))


def resolve_lifecycle(listings: DataFrame, closers: dict[str, DataFrame]) -> DataFrame:
    """Open or closed, when and why: the earliest closing wins, ties in the order given.

    A closing that the listings already carry is the first claim, so resolving again changes
    nothing; to reopen a listing, take its stored closing out first.
    """
    claims = None
    stored = {}
    if {"closed", "closed_date"} <= set(listings.columns):
        why = F.col("reason") if "reason" in listings.columns else F.lit("stored")
        stored = {"stored": listings.where("closed AND closed_date IS NOT NULL").select(
            F.col("listing_id"), "closed_date", why.alias("reason")
        )}
    for rank, (reason, rows) in enumerate((stored | closers).items()):
        told = F.coalesce("reason", F.lit(reason)) if "reason" in rows.columns else F.lit(reason)
        claim = rows.select(
            "listing_id",
            F.struct(
                F.col("closed_date"), F.lit(rank).alias("rank"), told.alias("reason")
            ).alias("claim"),
        )
        claims = claim if claims is None else claims.unionByName(claim)
    won = claims.groupBy("listing_id").agg(F.min("claim").alias("claim"))
    keep = [c for c in listings.columns if c not in ("closed", "closed_date", "reason")]
    return listings.join(won, "listing_id", "left").select(
        *keep,
        F.col("claim").isNotNull().alias("closed"),
        F.col("claim.closed_date").alias("closed_date"),
        F.col("claim.reason").alias("reason"),
    )


def daily_new(log: DataFrame, as_of: str) -> DataFrame:
    """New rows per UTC day; rows dated ahead count under the as-of day."""
    return new_per_day(first_seen(log), as_of)


def new_per_day(first: DataFrame, as_of: str) -> DataFrame:
    """Listings per UTC day of their ``first_ts``."""
    day = F.least(F.to_date("first_ts"), dates.day(as_of))
    return first.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"))
