"""Queries over the scan and link-check logs: lifecycle, yields, health."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacantia.functions.dates import iso
from vacantia.operators import counts, joins, lifecycle, quality, sets
from vacantia.plans.bindings import EVT_AS_OF
from vacantia.plans.catalog import query
from vacantia.plans.oracle import CHECKS, SCANS, with_

LOG = with_(SCANS)
LINKS = with_(CHECKS)
AS_OF = f"DATE '{EVT_AS_OF}'"
CUT = "2024-01-20"
#: A day inside the log, so that rows dated ahead occur.
NEW_AS_OF = "2024-01-10"


def _gaps(d):
    seen = lifecycle.sightings(d.scans())
    return lifecycle.gaps(seen, d.scan_days(), EVT_AS_OF, d.grace())


def _probes(d):
    from vacantia.sources.probes import last_per_day

    return last_per_day(d.checks())


def _iso(frame, *columns):
    return frame.withColumns({c: iso(F.col(c)) for c in columns})


def _sides(d):
    """Listings read before a day, and those read from it on."""
    ids = d.scans().select(F.col("listing_id").alias("id"), "day", "board")
    stored = ids.where(F.col("day") < CUT).select("id").distinct()
    scan = ids.where(F.col("day") >= CUT).select("id", "board").distinct()
    return scan, stored


_SIDES = f"""stored AS (SELECT DISTINCT listing_id AS id FROM scan WHERE day < DATE '{CUT}'),
  fresh AS (SELECT DISTINCT listing_id AS id, board FROM scan WHERE day >= DATE '{CUT}')"""


@query(
    "joi7_scan_vs_stored",
    with_(SCANS, _SIDES) + """SELECT coalesce(f.id, s.id) AS id, CASE WHEN s.id IS NULL THEN 'new'
      WHEN f.id IS NULL THEN 'missing' ELSE 'kept' END AS status
      FROM fresh f FULL JOIN stored s ON f.id = s.id""",
)
def _(d):
    scan, stored = _sides(d)
    return joins.scan_vs_stored(scan, stored)


@query(
    "set2_new_rows",
    with_(SCANS) + """SELECT DISTINCT listing_id AS id, board FROM scan WHERE day >= DATE '2024-01-03' AND listing_id NOT IN
      (SELECT listing_id FROM scan WHERE day < DATE '2024-01-03')""",
)
def _(d):
    rows = d.scans().select(F.col("listing_id").alias("id"), "day", "board")
    scan = rows.where("day >= '2024-01-03'").select("id", "board").distinct()
    return sets.new_rows(scan, rows.where("day < '2024-01-03'"))


@query(
    "win3_latest",
    LOG + """SELECT listing_id, event_id, value, CAST(day AS VARCHAR) AS day FROM scan
      QUALIFY row_number() OVER (PARTITION BY listing_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def _(d):
    rows = lifecycle.latest(d.scans(), ["ts", "event_id"])
    return _iso(rows.select("listing_id", "event_id", "value", "day"), "day")


@query(
    "win4_absence",
    LOG + """, step AS (SELECT *, day - lag(day) OVER (PARTITION BY listing_id ORDER BY day) AS g
        FROM seen), per AS (SELECT listing_id, board, max(day) AS last_seen,
        coalesce(max(g), 0) AS longest_gap FROM step GROUP BY ALL),
      last AS (SELECT board, max(day) AS last_scan FROM scan_day GROUP BY board)
      SELECT listing_id, board, CAST(last_seen AS VARCHAR) AS last_seen,
        CAST(last_scan AS VARCHAR) AS last_scan, CAST(longest_gap AS INTEGER) AS longest_gap,
        CAST(greatest(0, last_scan - last_seen) AS INTEGER) AS absent_days FROM per JOIN last USING (board)""",
)
def _(d):
    rows = lifecycle.absence(lifecycle.sightings(d.scans()), d.scan_days(), EVT_AS_OF)
    return _iso(rows, "last_seen", "last_scan")


@query(
    "win5_probe_streak",
    LINKS + """SELECT listing_id, CAST(probe_date AS VARCHAR) AS probe_date, outcome,
      CAST(streak AS INTEGER) AS streak, CAST(soft AS BIGINT) AS soft FROM streak""",
)
def _(d):
    return _iso(lifecycle.probe_streak(_probes(d)), "probe_date")


SPANS = """span AS (SELECT listing_id, min(day) AS first_seen, max(day) AS last_seen,
    max(next_day) FILTER (WHERE closed_on IS NOT NULL) AS last_reopened,
    max(closed_on) FILTER (WHERE next_day IS NULL) AS closed_date FROM gap GROUP BY listing_id)"""


@query(
    "win6_spans",
    with_(SCANS, SPANS) + """SELECT listing_id, CAST(first_seen AS VARCHAR) AS first_seen,
      CAST(last_seen AS VARCHAR) AS last_seen, CAST(last_reopened AS VARCHAR) AS last_reopened,
      CAST(closed_date AS VARCHAR) AS closed_date FROM span""",
)
def _(d):
    rows = lifecycle.spans(_gaps(d))
    return _iso(rows, "first_seen", "last_seen", "last_reopened", "closed_date")


@query(
    "str2_first_seen",
    LOG + "SELECT listing_id, CAST(min(ts) AS VARCHAR) AS first_ts FROM scan GROUP BY listing_id",
)
def _(d):
    rows = lifecycle.first_seen(d.scans())
    return rows.withColumn("first_ts", F.col("first_ts").cast("string"))


@query(
    "str3_close_absent",
    with_(SCANS, SPANS) + """SELECT listing_id, CAST(closed_date AS VARCHAR) AS closed_date
      FROM span WHERE closed_date IS NOT NULL""",
)
def _(d):
    return _iso(lifecycle.close_absent(_gaps(d)), "closed_date")


DEAD = """dead AS (SELECT listing_id, min(probe_date) AS closed_date FROM streak
    WHERE streak >= CASE WHEN soft > 0 THEN 3 ELSE 2 END
      AND NOT EXISTS (SELECT 1 FROM probe p WHERE p.listing_id = streak.listing_id
        AND p.outcome = 'ok' AND p.probe_date > streak.probe_date)
    GROUP BY listing_id)"""


@query(
    "str5_close_dead_links",
    with_(CHECKS, DEAD) + """SELECT listing_id, CAST(closed_date AS VARCHAR) AS closed_date
      FROM dead WHERE CAST(listing_id AS BIGINT) % 3 <> 2""",
)
def _(d):
    """A third of the users stand for community rows, a third for Amazon, a third for boards."""
    user = F.col("user_id") % 3
    rows = d.table("events").select(
        F.col("user_id").cast("string").alias("id"),
        F.when(user == 0, F.lit("community")).otherwise(F.lit("board")).alias("source"),
        F.when(user == 1, F.lit("amazon")).otherwise(F.lit("lever")).alias("platform"),
        F.lit("b").alias("board_key"),
    ).distinct()
    own = _probes(d).join(lifecycle.followed_by_link(rows), "listing_id", "left_semi")
    return _iso(lifecycle.close_dead_links(own), "closed_date")


@query(
    "str7_reopen",
    LOG + """SELECT listing_id, CAST(closed_on AS VARCHAR) AS closed_date,
      CAST(next_day AS VARCHAR) AS reopened_date FROM gap
      WHERE closed_on IS NOT NULL AND next_day IS NOT NULL""",
)
def _(d):
    return _iso(lifecycle.reopen(_gaps(d)), "closed_date", "reopened_date")


def closers(d):
    """Closings by reason; a listing of views has the checks of its user's link, one board is untracked."""
    links = lifecycle.close_dead_links(_probes(d)).withColumn(
        "listing_id", F.concat("listing_id", F.lit("-view"))
    )
    gone = d.scans().where("board = 'b7'").select("listing_id").distinct().select(
        "listing_id", F.lit(EVT_AS_OF).cast("date").alias("closed_date")
    )
    return {"absent": lifecycle.close_absent(_gaps(d)), "link gone": links, "untracked": gone}


@query(
    "str9_resolve_lifecycle",
    with_(SCANS, SPANS, CHECKS, DEAD) + f""", claim AS (
        SELECT listing_id, closed_date, 0 AS rank, 'absent' AS reason FROM span
          WHERE closed_date IS NOT NULL
        UNION ALL SELECT listing_id || '-view', closed_date, 1, 'link gone' FROM dead
        UNION ALL SELECT DISTINCT listing_id, {AS_OF}, 2, 'untracked' FROM scan WHERE board = 'b7'),
      won AS (SELECT * FROM claim QUALIFY row_number()
        OVER (PARTITION BY listing_id ORDER BY closed_date, rank) = 1)
      SELECT l.listing_id, l.board, w.listing_id IS NOT NULL AS closed,
        CAST(w.closed_date AS VARCHAR) AS closed_date, w.reason
      FROM (SELECT DISTINCT listing_id, board FROM scan) l LEFT JOIN won w USING (listing_id)""",
)
def _(d):
    rows = d.scans().select("listing_id", "board").distinct()
    return _iso(lifecycle.resolve_lifecycle(rows, closers(d)), "closed_date")


@query(
    "str10_daily_new",
    LOG + f"""SELECT CAST(least(CAST(f AS DATE), DATE '{NEW_AS_OF}') AS VARCHAR) AS day, count(*) AS n
      FROM (SELECT listing_id, min(ts) AS f FROM scan GROUP BY listing_id) GROUP BY 1""",
)
def _(d):
    return _iso(lifecycle.daily_new(d.scans(), NEW_AS_OF), "day")


_YIELD = """yield AS (SELECT board AS board_key, day AS scan_date, count(*) FILTER (WHERE scan_ok) AS n,
    count(*) FILTER (WHERE scan_ok AND value > 20) AS kept FROM scan GROUP BY ALL)"""


def _yields(d):
    """A failed scan lands nothing."""
    rows = d.scans().select(
        F.col("board").alias("board_key"), F.col("day").alias("scan_date"), "scan_ok",
        (F.col("value") > 20).alias("kept"),
    )
    return counts.board_yield(rows.where("scan_ok"), rows)


@query(
    "agg13_board_yield",
    with_(SCANS, _YIELD) + "SELECT board_key, CAST(scan_date AS VARCHAR) AS scan_date, n, kept FROM yield",
)
def _(d):
    return _iso(_yields(d), "scan_date")


@query(
    "qlt3_board_health",
    with_(SCANS, _YIELD) + """SELECT board_key, CAST(scan_date AS VARCHAR) AS scan_date, n,
      CASE WHEN usual IS NULL THEN 'no history' WHEN n = 0 THEN 'empty' WHEN n < 0.5 * usual THEN 'low'
        ELSE 'ok' END AS alarm FROM (SELECT *, avg(n) OVER (PARTITION BY board_key ORDER BY scan_date
        ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS usual FROM yield)""",
)
def _(d):
    rows = quality.board_health(_yields(d))
    return _iso(rows.select("board_key", "scan_date", "n", "alarm"), "scan_date")
