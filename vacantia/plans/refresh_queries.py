"""A whole scan: landed postings through boards, rules and links to new board rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacantia.dims import SEARCHED_PLATFORMS
from vacantia.operators import lifecycle, refresh, versions
from vacantia.plans import rule_sql as r
from vacantia.plans.bindings import EMPLOYERS, EVT_AS_OF, PLATFORMS, TTL_AS_OF, board_key_of, pick
from vacantia.plans.catalog import query
from vacantia.plans.oracle import EMPLOYERS as EMPLOYER_SQL
from vacantia.plans.oracle import CHECKS, SCANS, TITLES, board_key, q, with_
from vacantia.plans.oracle import pick as sql_pick
from vacantia.plans.rule_queries import FLAGS, JUDGED, PLACE
from vacantia.plans.scan_queries import CUT, DEAD, SPANS, closers
from vacantia.session import shared_dir
from vacantia.session import stored as stored_rows

AMAZON = 98
TERMS = ("cyber", "cloud", "security", "intern")

_TITLES = TITLES.replace(
    "p_partkey % 4 = 0 AS sec_co", f"(p_partkey % 100) % 3 = 0 AND p_partkey % 100 < {AMAZON} AS sec_co"
)
_ROWS = f"""landed AS (SELECT *, CASE WHEN posting_id % 100 >= {AMAZON} THEN 'amazon'
    ELSE {sql_pick(PLATFORMS, 'posting_id % 100')} END AS platform,
    {board_key('(posting_id % 100)', "''")} AS board_key FROM verdicts),
  kept AS (SELECT l.*, coalesce(e.name, 'Amazon') AS name FROM landed l
    LEFT JOIN employer e USING (platform, board_key)
    WHERE (e.name IS NOT NULL OR platform = 'amazon') AND verdict = 'in' AND (platform NOT IN ({', '.join(q(p) for p in SEARCHED_PLATFORMS)})
      OR len(list_filter([{', '.join(q(t) for t in TERMS)}] || coalesce(e.search_terms, []),
        lambda x: contains(' ' || lower(title), lower(x)))) > 0))"""


def _scraped(d):
    """Postings of all boards; two employers' numbers stand for Amazon, and some postings land twice."""
    n = (F.col("posting_id") % EMPLOYERS).cast("int")
    titles = d.titles().drop("sec_co")
    titles = titles.unionByName(titles.where("posting_id % 9 = 0"))
    postings = titles.withColumns(
        {
            "platform": F.when(n >= AMAZON, F.lit("amazon")).otherwise(pick(PLATFORMS, n)),
            "board_key": board_key_of(n, F.lit("")),
            "url": F.concat(F.lit("https://jobs.example.com/"), F.col("posting_id").cast("string")),
        }
    )
    return refresh.board_rows(postings, d.employers(), d.vendor_domains(), TTL_AS_OF, TERMS)


@query(
    "refresh_board",
    with_(_TITLES, FLAGS, r.facts("title", "posting_id", "description"), PLACE, JUDGED,
          EMPLOYER_SQL, _ROWS)
    + """SELECT platform || '/' || board_key || '/' || posting_id AS id, name AS company, type, category,
      replace(kept, ';', '; ') AS location, 'board' AS source FROM kept WHERE posting_id % 4 <> 1
      UNION ALL SELECT 'issue/' || doc_id, source, 'intern', 'Security Engineering', 'Remote (US)', 'community'
      FROM documents""",
)
def _(d):
    scraped = stored_rows(_scraped(d), "scan")
    key = F.substring_index("id", "/", -1).cast("long")
    stored = scraped.where(key % 4 == 1)
    community = d.table("documents").select(
        F.concat(F.lit("issue/"), F.col("doc_id").cast("string")).alias("id"),
        F.col("source").alias("company"), F.lit("intern").alias("type"),
        F.lit("Security Engineering").alias("category"), F.lit("Remote (US)").alias("location"),
    )
    new = refresh.merge_scan(scraped, community, stored)
    return new.select("id", "company", "type", "category", "location", "source")


_STORED = f"""stored AS (SELECT listing_id AS id, board, user_id % 6 = 0 OR user_id % 10 = 7 AS closed,
    CASE WHEN user_id % 10 = 7 THEN DATE '{CUT}' - 1 WHEN user_id % 6 = 0 THEN DATE '{CUT}' END AS closed_date,
    CASE WHEN user_id % 10 = 7 THEN 'untracked' WHEN user_id % 6 = 0 THEN 'absent' END AS reason
    FROM scan WHERE day < DATE '{CUT}' GROUP BY ALL),
  found AS (SELECT DISTINCT listing_id AS id, board FROM seen WHERE day > DATE '{CUT}'),
  every AS (SELECT * FROM stored UNION ALL
    SELECT id, board, FALSE, NULL, NULL FROM found WHERE id NOT IN (SELECT id FROM stored)),
  back AS (SELECT e.id, min(s.day) AS back FROM every e JOIN seen s ON s.listing_id = e.id
    WHERE e.closed AND s.day > e.closed_date GROUP BY e.id),
  last AS (SELECT listing_id AS id, max(day) AS last_seen FROM seen GROUP BY 1),
  claims AS (SELECT e.id, closed_date, 0 AS rank, reason FROM every e LEFT JOIN back USING (id)
      WHERE closed AND back IS NULL
    UNION ALL SELECT listing_id, closed_date, 1, 'absent' FROM span WHERE closed_date IS NOT NULL
    UNION ALL SELECT listing_id || '-view', closed_date, 2, 'link gone' FROM dead LEFT JOIN last
      ON last.id = listing_id || '-view' WHERE last_seen IS NULL OR closed_date >= last_seen
    UNION ALL SELECT DISTINCT listing_id, DATE '{EVT_AS_OF}', 3, 'untracked' FROM scan WHERE board = 'b7' AND user_id % 4 = 3),
  won AS (SELECT * FROM claims QUALIFY row_number() OVER (PARTITION BY id ORDER BY closed_date, rank) = 1)"""


_UPDATED = f"""SELECT e.id, e.board, w.id IS NOT NULL AS closed,
      CAST(w.closed_date AS VARCHAR) AS closed_date, w.reason, CAST(b.back AS VARCHAR) AS reopened_date
      FROM every e LEFT JOIN won w USING (id) LEFT JOIN back b USING (id)
      WHERE w.id IS NULL OR DATE '{EVT_AS_OF}' - w.closed_date <= 7"""
_TABLE_SQL = with_(SCANS, SPANS, CHECKS, DEAD, _STORED) + _UPDATED
_COLUMNS = ("id", "board", "closed", "closed_date", "reason", "reopened_date")


def _before(d):
    """The table as it stood on a day, some rows closed, one board's as untracked."""
    user, cut = F.col("user_id"), F.lit(CUT).cast("date")
    gone = user % 10 == 7
    return d.scans().where(F.col("day") < cut).select(
        F.col("listing_id").alias("id"), "board", ((user % 6 == 0) | gone).alias("closed"),
        F.when(gone, F.date_sub(cut, 1)).when(user % 6 == 0, cut).alias("closed_date"),
        F.when(gone, F.lit("untracked")).when(user % 6 == 0, F.lit("absent")).alias("reason"),
        F.lit(None).cast("date").alias("reopened_date"),
    ).distinct()


def _after(d, stored):
    """The stored table after everything the log holds; a part of one board is no longer tracked."""
    seen = lifecycle.sightings(d.scans())
    found = seen.where(F.col("day") > F.lit(CUT).cast("date")).select(
        F.col("listing_id").alias("id"), "board", F.lit(False).alias("closed"),
        F.lit(None).cast("date").alias("closed_date"), F.lit(None).cast("date").alias("reopened_date"),
    ).distinct()
    now = closers(d) | {"untracked": d.scans().where("board = 'b7' AND user_id % 4 = 3").select("listing_id").distinct().select(
        "listing_id", F.lit(EVT_AS_OF).cast("date").alias("closed_date")
    )}
    return refresh.update_table(stored, found, seen, now, EVT_AS_OF, days=7).select(*_COLUMNS)


def _days_as_text(rows):
    return rows.withColumns({c: F.col(c).cast("string") for c in ("closed_date", "reopened_date")})


@query("refresh_update_table", _TABLE_SQL)
def _(d):
    return _days_as_text(_after(d, _before(d)))


@query("snk1_commit_table", _TABLE_SQL)
def _(d):
    """The table stored by board, updated over itself, and updated again, which commits nothing."""
    path, board = shared_dir(d.spark, "listings"), F.col("board")
    stored = _before(d)
    first = versions.commit(stored, path, board, versions.Version())
    # A run that breaks before its version is named leaves rows that no reader sees.
    versions.write(stored.where("closed"), path, board)
    for _ in range(2):
        last = refresh.commit_update(d.spark, path, stored.schema, board, lambda held: _after(d, held))
    if last.number != first.number + 1:
        raise RuntimeError("an update without changes made a version")
    return _days_as_text(versions.read(d.spark, path, stored.schema))
