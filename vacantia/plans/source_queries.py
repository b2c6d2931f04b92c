"""Queries over sources, sinks, links, shared views and output checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacantia import shared_dir
from vacantia.dims import PLATFORM_KEYS, SEARCHED_PLATFORMS
from vacantia.functions import urls
from vacantia.functions.dates import iso
from vacantia.functions.text import word_text
from vacantia.operators import lifecycle, prepare, publish, quality, repeats, sets, views
from vacantia.plans.bindings import CATEGORIES, LST_AS_OF, PLATFORMS
from vacantia.plans.catalog import query
from vacantia.plans.oracle import (
    CHECKS, EMPLOYERS, LISTINGS, POSTINGS, SHARED, board_key, lst, pick, q, with_,
    word_text as sql_words,
)
from vacantia.session import stored
from vacantia.sources import community, listings, postings, probes, published

AS_OF = f"DATE '{LST_AS_OF}'"
BOARD = with_(LISTINGS)


# --- sources ------------------------------------------------------------------------------


@query(
    "src1_read_listings",
    BOARD + """SELECT id, type, company, array_to_string(states, ';') AS states, closed,
      CAST(date_added AS VARCHAR) AS date_added, CAST(closed_date AS VARCHAR) AS closed_date
      FROM listing WHERE k % 10 <> 9""",
)
def _(d):
    """Landed documents of at most 64 rows each, some rows of an unknown type."""
    rows = d.listings("places")
    key = F.col("id").cast("long")
    row = F.struct(
        "id",
        F.when(key % 10 == 9, F.lit("senior")).otherwise(F.col("type")).alias("type"),
        "company", "role", "category", "location",
        F.when(F.size("states") > 0, F.col("states")).alias("states"),
        F.when(F.col("closed"), F.col("closed")).alias("closed"),
        iso(F.col("date_added")).alias("date_added"),
        iso(F.col("closed_date")).alias("closed_date"),
    )
    documents = rows.groupBy(F.floor(key / 64).alias("doc")).agg(F.collect_list(row).alias("rows"))
    texts = documents.select(F.to_json(F.struct("rows")).alias("document"))
    return listings.parse_listings(texts).select(
        "id", "type", "company", F.array_join("states", ";").alias("states"), "closed",
        iso(F.col("date_added")).alias("date_added"), iso(F.col("closed_date")).alias("closed_date"),
    )


@query(
    "src2_union_postings",
    f"""SELECT {pick(PLATFORMS + ['amazon', 'community'], "CAST(substring(source, 4) AS INTEGER)")}
      AS platform, source AS board_key, CAST(doc_id AS VARCHAR) AS posting_id,
      md5(text) AS body, CASE WHEN CAST(substring(source, 4) AS INTEGER) % 14 < 7 THEN lang END AS location
      FROM documents""",
)
def _(d):
    """The documents as dumps of fourteen sources; the first seven also land a location."""
    docs = d.table("documents")
    number = F.substring("source", 4, 4).cast("int") % 14
    dumps = {}
    for i, platform in enumerate([*PLATFORM_KEYS, "amazon", "community"]):
        own = docs.where(number == i)
        if i < 7:
            shaped = own.select(
                F.col("doc_id").alias("job_id"), F.col("text").alias("content"),
                F.col("lang").alias("office"), "source",
            )
            columns = {
                "board_key": "source", "posting_id": "CAST(job_id AS STRING)",
                "location": "office", "description": "content",
            }
        else:
            shaped = own.select(F.struct("doc_id", "text").alias("job"), "source")
            columns = {
                "board_key": "source", "posting_id": "CAST(job.doc_id AS STRING)",
                "description": "job.text",
            }
        dumps[platform] = (shaped, columns)
    union = postings.union_postings(dumps)
    return union.select(
        "platform", "board_key", "posting_id", F.md5("description").alias("body"), "location"
    )


@query(
    "src3_employers",
    with_(EMPLOYERS) + """SELECT platform, name, board_key, security_company,
      array_to_string(apply_hosts, ';') AS hosts, array_to_string(search_terms, ';') AS terms
      FROM employer""",
)
def _(d):
    return d.employers().select(
        "platform", "name", "board_key", "security_company",
        F.array_join("apply_hosts", ";").alias("hosts"),
        F.array_join("search_terms", ";").alias("terms"),
    )


_BODY = f"""body AS (SELECT doc_id AS issue_id, doc_id % 3 <> 0 AS approved,
    '### Company' || chr(10) || source || chr(10) || '### Title' || chr(10) || text
    || (['', chr(10) || '<details>x</details>', chr(10) || '### Title' || chr(10) || 'other',
         chr(10) || '<!-- x -->', ''])[CAST(doc_id % 5 AS INTEGER) + 1] AS body FROM documents),
  judged AS (SELECT issue_id, CASE WHEN NOT approved THEN 'not approved'
    WHEN regexp_matches(body, {q('<[!/a-zA-Z]')}) THEN 'html in body'
    WHEN len(regexp_extract_all(body, '(?m)^### (.+)$', 1)) <>
      len(list_distinct(regexp_extract_all(body, '(?m)^### (.+)$', 1))) THEN 'repeated heading'
    END AS reason FROM body)"""


@query("src4_submissions", f"WITH {_BODY} SELECT issue_id, reason FROM judged")
def _(d):
    return community.judge_submissions(d.submissions()).select("issue_id", "reason")


@query(
    "src4_approved_submissions",
    f"WITH {_BODY} SELECT CAST(issue_id AS VARCHAR) AS posting_id, 'Security Intern ' || issue_id "
    "AS title FROM judged WHERE reason IS NULL",
)
def _(d):
    taken, _rejected = community.approved_submissions(d.submissions())
    return taken.select("posting_id", "title")


@query(
    "src5_prune_by_terms",
    with_(LISTINGS, EMPLOYERS, POSTINGS) + f"""SELECT p.id, p.platform FROM posting p LEFT JOIN employer e
      USING (platform, board_key) WHERE p.platform NOT IN ({', '.join(q(s) for s in SEARCHED_PLATFORMS)})
      OR len(list_filter(['small', 'cyber'] || coalesce(e.search_terms, CAST([] AS VARCHAR[])),
        lambda t: contains({sql_words('role')}, lower(t)))) > 0""",
)
def _(d):
    hay = word_text(F.col("title"))
    kept = postings.prune_by_terms(d.postings("role"), d.employers(), hay, ("small", "cyber"))
    return kept.select("id", "platform")


@query(
    "src6_read_published",
    BOARD + f"""SELECT type, closed, company, role, coalesce(p_company = company AND p_date = date_added,
      FALSE) AND NOT closed AS is_repeat, CASE WHEN NOT closed THEN clearance ELSE FALSE END AS clearance,
      CASE WHEN NOT closed THEN category END AS category, CASE WHEN NOT closed THEN url END AS url,
      CASE WHEN NOT closed THEN array_to_string(CASE WHEN len(locations) = 0 THEN ['United States']
        ELSE locations END, ';') END AS places,
      CASE WHEN NOT closed THEN CAST(date_added AS VARCHAR) END AS date_added,
      CASE WHEN closed THEN CAST(closed_date AS VARCHAR) END AS closed_date
      FROM (SELECT *, lag(company) OVER w AS p_company, lag(date_added) OVER w AS p_date FROM board
        WINDOW w AS (PARTITION BY type, closed ORDER BY date_added DESC, lower(company), company, id))""",
)
def _(d):
    """Writes the published tables as text and reads them back."""
    board = d.board("role", "places", "clearance")
    path = shared_dir(d.spark, "published")
    publish.write_published(board.withColumn("is_new", prepare.is_new()), path)
    rows = published.read_published(d.spark, path, LST_AS_OF)
    return rows.select(
        "type", "closed", "company", "role", "is_repeat", "clearance", "category", "url",
        F.when(~F.col("closed"), F.array_join("locations", ";")).alias("places"),
        iso(F.col("date_added")).alias("date_added"), iso(F.col("closed_date")).alias("closed_date"),
    )


@query(
    "src7_probes",
    with_(CHECKS) + """SELECT listing_id, CAST(probe_date AS VARCHAR) AS probe_date, outcome
      FROM probe""",
)
def _(d):
    return probes.last_per_day(d.checks()).withColumn("probe_date", iso(F.col("probe_date")))


# --- sinks --------------------------------------------------------------------------------


@query(
    "snk1_write_board",
    BOARD + f"""SELECT id, type, closed, company, CAST(date_added AS VARCHAR) AS date_added
      FROM listing WHERE NOT closed OR {AS_OF} - closed_date <= 60""",
)
def _(d):
    path = shared_dir(d.spark, "board")
    publish.write_board(d.listings(), path, LST_AS_OF)
    rows = d.spark.read.parquet(path)
    return rows.select(
        "id", "type", F.col("closed").cast("boolean").alias("closed"), "company",
        iso(F.col("date_added")).alias("date_added"),
    )


_NEW = "board WHERE NOT closed AND age <= 7"


def _new(d, *need):
    rows = d.board(*need).where(prepare.is_new())
    return rows.withColumn("scan_date", F.col("date_added"))


@query(
    "snk2_feeds",
    BOARD + f"""SELECT feed, id, company, role FROM (SELECT unnest(['all', type]) AS feed, *
      FROM {_NEW})""",
)
def _(d):
    return publish.feed_rows(_new(d, "role")).select("feed", "id", "company", "role")


@query(
    "snk3_releases",
    BOARD + f"""SELECT CAST(date_added AS VARCHAR) AS scan_date, count(*) AS n,
      count(*) FILTER (WHERE type = 'intern') AS intern,
      count(*) FILTER (WHERE type = 'newgrad') AS newgrad,
      count(*) FILTER (WHERE type = 'earlycareer') AS earlycareer FROM {_NEW} GROUP BY date_added""",
)
def _(d):
    return publish.release_batches(_new(d)).withColumn("scan_date", iso(F.col("scan_date")))


@query(
    "snk3_release_entries",
    BOARD + f"""SELECT CAST(date_added AS VARCHAR) AS scan_date, id, company,
      count(*) OVER (PARTITION BY date_added) AS batch_n FROM {_NEW}""",
)
def _(d):
    rows = publish.release_entries(_new(d))
    return rows.select(iso(F.col("scan_date")).alias("scan_date"), "id", "company", "batch_n")


@query(
    "snk4_alerts",
    BOARD + f"""SELECT type, CAST(date_added AS VARCHAR) AS scan_date, count(*) AS n,
      min(company) AS first_company, max_by(id, (company, id)) AS last_id
      FROM {_NEW} GROUP BY type, date_added""",
)
def _(d):
    alerts = publish.alert_batches(_new(d))
    return alerts.select(
        "type", iso(F.col("scan_date")).alias("scan_date"), "n",
        F.col("first.company").alias("first_company"), F.col("last.id").alias("last_id"),
    )


# --- links --------------------------------------------------------------------------------

_URL = """CASE WHEN page_id % 13 = 0 THEN replace(url, 'https://', 'ftp://')
    WHEN page_id % 17 = 0 THEN url || ' x'
    WHEN page_id % 19 = 0 THEN replace(url, '/en/', '\\en/') ELSE url END"""
_SAFE = r"regexp_matches(url, '(?i)^https?://[^\s\\]+$')"
_LINK = f"link AS (SELECT page_id, page_id % 100 AS n, {_URL} AS url FROM pages)"


@query(
    "prj8_safe_url",
    f"""WITH {_LINK} SELECT CAST(page_id AS VARCHAR) AS posting_id,
      CASE WHEN {_SAFE} THEN url ELSE '' END AS url FROM link""",
)
def _(d):
    return prepare.safe_links(d.links()).select("posting_id", "url")


@query(
    "prj9_trusted_link",
    f"""{with_(EMPLOYERS, _LINK)}, l2 AS (SELECT *, {pick(PLATFORMS, 'n')} AS platform,
      {board_key('n', "''")} AS board_key,
      ({lst(['example.com', 'example.org', 'vendor.example'])})[CAST((n % 12) % 3 AS INTEGER) + 1] AS domain,
      CASE WHEN {_SAFE} THEN lower(regexp_extract(url, '^https?://([^/?#:]+)', 1)) END AS host FROM link),
      l3 AS (SELECT l2.*, coalesce(host = domain OR ends_with(host, '.' || domain), FALSE)
        OR coalesce(list_contains(e.apply_hosts, host), FALSE) AS trusted
        FROM l2 LEFT JOIN employer e USING (platform, board_key))
      SELECT CAST(page_id AS VARCHAR) AS posting_id, trusted, CASE WHEN trusted THEN url ELSE
        'https://' || platform || '.vendor.example/' || board_key || '/' || page_id END AS link FROM l3""",
)
def _(d):
    rows = prepare.trusted_links(d.links(), d.employers(), d.vendor_domains())
    return rows.select("posting_id", "trusted", "link")


# --- shared and saved views ---------------------------------------------------------------


def _views(d):
    return views.normalize_views(d.shared_links(), d.known_slugs(), d.known_places())


_ACTIVE = """CAST(len(cat) + (state <> '')::INT + (days <> '')::INT + noclear::INT + closed::INT
    AS INTEGER)"""
_CANON = """concat_ws('&', CASE WHEN type <> 'intern' THEN 'type=' || type END,
    CASE WHEN trim(q) <> '' THEN 'q=' || replace(replace(url_encode(trim(q)), '%20', '+'), '%2C', ',') END,
    CASE WHEN len(cat) > 0 THEN 'cat=' || array_to_string(cat, ',') END,
    CASE WHEN state <> '' THEN 'state=' || state END, CASE WHEN days <> '' THEN 'days=' || days END,
    CASE WHEN noclear THEN 'noclear=1' END, CASE WHEN closed THEN 'closed=1' END,
    CASE WHEN sort <> '' THEN 'sort=' || sort END)"""


@query(
    "flt9_normalize_views",
    with_(SHARED) + """SELECT view_id, type, q, array_to_string(cat, ',') AS cat, state, days,
      noclear, closed, sort FROM "view" """,
)
def _(d):
    return _views(d).withColumn("cat", F.array_join("cat", ","))


@query("flt10_active_filters", with_(SHARED) + f'SELECT view_id, {_ACTIVE} AS n FROM "view"')
def _(d):
    return _views(d).select("view_id", views.active_filters().alias("n"))


@query(
    "flt11_canonical_view",
    with_(SHARED) + f'SELECT {_CANON} AS "view", count(*) AS n FROM "view" GROUP BY 1',
)
def _(d):
    return views.group_views(_views(d))


@query(
    "set4_known_only",
    with_(SHARED) + """SELECT view_id, array_to_string(cat, ',') AS cat FROM "view" """,
)
def _(d):
    chosen = d.shared_links().withColumn("slugs", d.known_slugs())
    cat = F.split(urls.query_param(F.col("url"), "cat"), ",")
    return chosen.select(
        "view_id", F.array_join(sets.known_only(cat, F.col("slugs")), ",").alias("cat")
    )


@query(
    "joi4_saved_searches",
    with_(LISTINGS, SHARED) + """, v AS (SELECT view_id, type, q, list_sort(list_distinct(cat)) AS cat, state,
      days, noclear, closed, list_sort(list_distinct(list_filter(regexp_split_to_array(
        strip_accents(lower(q)), '[^a-z0-9+#]+'), lambda w: w <> ''))) AS needles FROM "view"),
      s AS (SELECT min(view_id) AS search_id, type, cat, state, days, noclear, closed, needles
        FROM v GROUP BY ALL)
      SELECT s.search_id, b.id FROM s JOIN board b ON b.type = s.type
        AND (s.closed OR NOT b.closed) AND (NOT s.noclear OR NOT b.clearance)
        AND (s.days = '' OR b.age <= TRY_CAST(s.days AS INTEGER))
        AND (s.state = '' OR (s.state = 'remote' AND b.remote) OR list_contains(b.states, s.state))
        AND (len(s.cat) = 0 OR list_contains(s.cat, b.slug))
        AND len(list_filter(s.needles, lambda w: NOT contains(b.hay, ' ' || w))) = 0""",
)
def _(d):
    board = stored(d.board("role", "places", "clearance"), "board")
    return views.saved_search_matches(_views(d), board)


@query(
    "joi4_view_searches",
    with_(SHARED) + """, v AS (SELECT view_id, type, list_sort(list_distinct(cat)) AS cat, state, days, noclear,
      closed, list_sort(list_distinct(list_filter(regexp_split_to_array(strip_accents(lower(q)),
        '[^a-z0-9+#]+'), lambda w: w <> ''))) AS needles FROM "view")
      SELECT view_id, min(view_id) OVER (PARTITION BY type, cat, state, days, noclear, closed, needles)
        AS search_id FROM v""",
)
def _(d):
    return views.view_searches(_views(d))


# --- checks of the output -----------------------------------------------------------------


def _published(d):
    """What a faulty run would have printed: rows dropped, printed twice, marked wrongly."""
    key = F.col("id").cast("long")
    rows = repeats.published(d.listings("role"))
    printed = rows.where(key % 50 != 7).unionByName(rows.where(key % 50 == 9))
    wrong = F.when(key % 41 == 3, ~F.col("is_repeat")).otherwise(F.col("is_repeat"))
    return printed.withColumn("is_repeat", wrong)


@query(
    "qlt1_reconcile",
    BOARD + """, o AS (SELECT CASE WHEN closed THEN concat_ws('/', type, company, role) ELSE url END AS key,
        closed, CASE k % 50 WHEN 7 THEN -1 WHEN 9 THEN 1 ELSE 0 END AS step,
        NOT closed AND k % 41 = 3 AS wrong FROM listing),
      p AS (SELECT key, closed, sum(step) AS balance, bool_or(wrong) AS wrong FROM o GROUP BY ALL)
      SELECT issue, count(*) AS n FROM (SELECT CASE WHEN balance < 0 THEN 'missing row'
        WHEN balance > 0 THEN 'extra row' WHEN wrong THEN 'repeat marker' END AS issue FROM p)
      WHERE issue IS NOT NULL GROUP BY issue""",
)
def _(d):
    return quality.reconcile(_published(d), d.listings("role"))


@query(
    "qlt1_out_of_order",
    BOARD + """, p AS (SELECT type, closed, CASE WHEN closed THEN closed_date ELSE date_added END AS day, company, id
        FROM listing),
      o AS (SELECT type, closed, day, company, id,
        CASE WHEN company LIKE '%3' AND day(day) % 7 = 2 THEN day + 40 ELSE day END AS late,
        CASE WHEN company LIKE '%4' AND day(day) % 3 = 0 THEN 'ZZ ' || company ELSE company END AS name FROM p),
      w AS (SELECT *, lag(late) OVER above AS late0, lag(name) OVER above AS name0 FROM o
        WINDOW above AS (PARTITION BY type, closed ORDER BY day DESC, lower(company), company, id))
      SELECT type, closed, CAST(count(*) FILTER (WHERE late > late0 OR (late = late0 AND (lower(name) < lower(name0)
        OR (lower(name) = lower(name0) AND name < name0)))) AS BIGINT) AS n FROM w GROUP BY ALL""",
)
def _(d):
    """The published tables read back, some rows with a day or an employer that does not fit their place."""
    board = d.board("role").withColumn("is_new", prepare.is_new())
    path = shared_dir(d.spark, "published")
    publish.write_published(board, path)
    rows = published.read_published(d.spark, path, LST_AS_OF)
    day = F.when(F.col("closed"), F.col("closed_date")).otherwise(F.col("date_added"))
    late = F.endswith(F.col("company"), F.lit("3")) & (F.dayofmonth(day) % 7 == 2)
    renamed = F.endswith(F.col("company"), F.lit("4")) & (F.dayofmonth(day) % 3 == 0)
    moved = {c: F.when(late, F.date_add(c, 40)).otherwise(F.col(c)) for c in ("date_added", "closed_date")}
    name = F.when(renamed, F.concat(F.lit("ZZ "), "company")).otherwise(F.col("company"))
    return quality.out_of_order(rows.withColumns(moved | {"company": name}))


_BROKEN = """bad AS (SELECT CASE WHEN k % 29 = 28 THEN CAST(k - 28 AS VARCHAR) ELSE id END AS id,
    CASE WHEN k % 31 = 1 THEN 'senior' ELSE type END AS type,
    CASE WHEN k % 37 = 2 THEN 'Other' ELSE category END AS category,
    CASE WHEN k % 23 = 5 THEN '2001-13-01' ELSE CAST(date_added AS VARCHAR) END AS date_added,
    closed, CASE WHEN k % 19 <> 3 THEN CAST(closed_date AS VARCHAR) END AS closed_date,
    CASE WHEN k % 17 = 4 THEN 'ftp://x' WHEN k % 43 = 42 THEN 'https://jobs.example.com/0' ELSE url END
      AS url FROM listing)"""


@query(
    "qlt2_validate",
    with_(LISTINGS, _BROKEN) + f"""SELECT 'type' AS rule, id FROM bad
        WHERE type NOT IN ('intern', 'newgrad', 'earlycareer')
      UNION ALL SELECT 'category', id FROM bad WHERE NOT list_contains({lst(CATEGORIES)}, category)
      UNION ALL SELECT 'date', id FROM bad WHERE TRY_CAST(date_added AS DATE) IS NULL
      UNION ALL SELECT 'closed without date', id FROM bad WHERE closed AND closed_date IS NULL
      UNION ALL SELECT 'link', id FROM bad WHERE NOT regexp_matches(url, '^https?://')
      UNION ALL SELECT 'id', id FROM bad GROUP BY id HAVING count(*) > 1
      UNION ALL SELECT 'duplicate link', min(id) FROM bad GROUP BY url HAVING count(*) > 1""",
)
def _(d):
    key = F.col("id").cast("long")
    rows = d.listings()
    broken = rows.select(
        F.when(key % 29 == 28, (key - 28).cast("string")).otherwise(F.col("id")).alias("id"),
        F.when(key % 31 == 1, F.lit("senior")).otherwise(F.col("type")).alias("type"),
        F.when(key % 37 == 2, F.lit("Other")).otherwise(F.col("category")).alias("category"),
        F.when(key % 23 == 5, F.lit("2001-13-01")).otherwise(iso(F.col("date_added"))).alias(
            "date_added"
        ),
        "closed",
        F.when(key % 19 != 3, iso(F.col("closed_date"))).alias("closed_date"),
        F.when(key % 17 == 4, F.lit("ftp://x"))
        .when(key % 43 == 42, F.lit("https://jobs.example.com/0"))
        .otherwise(F.col("url")).alias("url"),
    )
    return quality.validate(broken, CATEGORIES)


# --- lifecycle over stored listings ---------------------------------------------------------


@query(
    "str4_close_untracked",
    with_(LISTINGS, EMPLOYERS) + f"""SELECT id AS listing_id, '{LST_AS_OF}' AS closed_date FROM listing
      WHERE NOT closed AND company NOT IN (SELECT name FROM employer)""",
)
def _(d):
    rows = lifecycle.close_untracked(d.listings(), d.employers(), LST_AS_OF)
    return rows.withColumn("closed_date", iso(F.col("closed_date")))


_EXPIRY = "CAST(greatest(date_added, coalesce(reopened_date, date_added)) + 120 AS DATE)"


@query(
    "str6_expire_community",
    BOARD + f"""SELECT id AS listing_id, CAST({_EXPIRY} AS VARCHAR) AS closed_date FROM listing
      WHERE source = 'community' AND {_EXPIRY} <= {AS_OF}""",
)
def _(d):
    rows = lifecycle.expire_community(d.listings(), LST_AS_OF)
    return rows.withColumn("closed_date", iso(F.col("closed_date")))


def _retained(name: str, days: int):
    @query(
        name,
        BOARD + f"SELECT id, closed FROM listing WHERE NOT closed OR {AS_OF} - closed_date <= {days}",
    )
    def _(d):
        return lifecycle.retain_closed(d.listings(), LST_AS_OF, days).select("id", "closed")


_retained("str8_retain_tables", 60)
_retained("str8_retain_page", 14)
