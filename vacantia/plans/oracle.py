"""The bindings in SQL: text that the check queries start with."""

from __future__ import annotations

from vacantia.dims import PLATFORM_KEYS, STATE_NAMES
from vacantia.plans import bindings as b


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def lst(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def pick(values, index: str) -> str:
    return f"({lst(values)})[CAST(({index}) % {len(values)} AS INTEGER) + 1]"


def has(words: list[str], t: str = "t") -> str:
    return f"regexp_matches({t}, {q(' (?:' + '|'.join(words) + ') ')})"


STATE_MAP = "MAP {" + ", ".join(f"{q(c)}: {q(n)}" for c, n in STATE_NAMES.items()) + "}"


def fold(text: str) -> str:
    return f"strip_accents(lower({text}))"


def word_text(text: str) -> str:
    return f"(' ' || trim(regexp_replace({fold(text)}, '[^a-z0-9+#]+', ' ', 'g')))"


def slug(text: str) -> str:
    dashed = f"regexp_replace(replace(lower({text}), '&', 'and'), '[^a-z0-9]+', '-', 'g')"
    return f"regexp_replace({dashed}, '^-|-$', '', 'g')"


def board_key(n: str, suffix: str) -> str:
    cases = " ".join(
        f"WHEN {i} THEN "
        + " || '/' || ".join(f"{q(p)} || {n} || {suffix}" for p in parts)
        for i, parts in enumerate(PLATFORM_KEYS.values())
    )
    return f"CASE ({n}) % {len(PLATFORM_KEYS)} {cases} END"


LISTINGS = f"""
spot AS (
  SELECT s_suppkey, n_name, n_regionkey,
    coalesce(({lst(b.STATE_CODES)})[n_nationkey + 1], n_name) AS state
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
li AS (
  SELECT l_orderkey, min(p_name) || ' ' || max(p_name) AS role,
    list(DISTINCT n_name ORDER BY n_name) AS locations,
    list(DISTINCT state ORDER BY state) AS states,
    bool_or(n_regionkey = 0) AS remote
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN spot ON l_suppkey = s_suppkey
  GROUP BY l_orderkey),
listing AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderkey AS k, o_custkey % 100 AS n,
    {pick(['intern', 'newgrad', 'earlycareer'], 'o_orderkey')} AS type,
    'co' || (o_custkey % 100) AS company,
    coalesce(role, '') AS role,
    o_orderpriority AS category,
    coalesce(array_to_string(locations, '; '), '') AS location,
    coalesce(locations, CAST([] AS VARCHAR[])) AS locations,
    coalesce(states, CAST([] AS VARCHAR[])) AS states,
    coalesce(remote, FALSE) AS remote,
    c_acctbal < 0 AS clearance,
    'https://jobs.example.com/' || o_orderkey AS url,
    DATE '{b.LST_AS_OF}' + 1 - CAST(o_orderkey % 181 AS INTEGER) AS date_added,
    o_orderstatus = 'F' AS closed,
    CASE WHEN o_orderstatus = 'F' THEN least(DATE '{b.LST_AS_OF}',
      DATE '{b.LST_AS_OF}' + 1 - CAST(o_orderkey % 181 AS INTEGER)
        + CAST(o_custkey % 91 AS INTEGER)) END AS closed_date,
    CASE WHEN o_orderkey % 5 = 0 THEN 'community' ELSE 'board' END AS source,
    CASE WHEN o_orderkey % 35 = 0 THEN
      DATE '{b.LST_AS_OF}' + 31 - CAST(o_orderkey % 181 AS INTEGER) END AS reopened_date
  FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN li ON o_orderkey = l_orderkey),
board AS (
  SELECT *, {slug('category')} AS slug,
    CAST(greatest(0, DATE '{b.LST_AS_OF}' - date_added) AS INTEGER) AS age,
    {word_text("concat_ws(' ', company, role, location, category, array_to_string("
               "list_transform(states, lambda s: coalesce((" + STATE_MAP + ")[s], '')), ' '),"
               " CASE WHEN remote THEN 'remote' ELSE '' END)")} AS hay
  FROM listing)
"""

EMPLOYERS = f"""
nums AS (SELECT DISTINCT o_custkey % 100 AS n FROM orders WHERE o_custkey % 100 < {b.CONFIGURED}),
boards AS (
  SELECT n, suffix FROM nums, (VALUES (''), ('b')) AS s(suffix) WHERE suffix = '' OR n < 5),
employer AS (
  SELECT {pick(b.PLATFORMS, 'n')} AS platform, 'co' || n AS name,
    {board_key('n', 'suffix')} AS board_key, n % 3 = 0 AS security_company,
    CASE WHEN n % 2 = 0 THEN ['blog.tionsh.example.net'] ELSE CAST([] AS VARCHAR[]) END
      AS apply_hosts,
    CASE WHEN n % 4 = 0 THEN ['Ring'] ELSE CAST([] AS VARCHAR[]) END AS search_terms
  FROM boards)
"""

POSTINGS = f"""
posting AS (
  SELECT *, {pick(b.PLATFORMS, 'n')} AS platform,
    {board_key('n', "(CASE WHEN n < 5 AND k % 2 = 1 THEN 'b' ELSE '' END)")} AS board_key
  FROM listing)
"""

TITLES = f"""
raw_title AS (
  SELECT p_partkey AS posting_id,
    CASE WHEN p_partkey % 2 = 1 THEN p_name || ' ' ELSE '' END ||
      trim(regexp_replace(concat_ws(' ', {pick(b.LEADS, 'p_size')}, {pick(b.PRODUCTS, 'p_partkey')},
      {pick(b.NOUNS, 'p_partkey // 17')}, {pick(b.LEVELS, 'p_partkey // 7 + p_size')}),
      ' +', ' ', 'g')) AS title,
    {pick(b.PLACES, 'p_partkey + p_size')} AS location,
    p_name || chr(10) || {pick(b.DEMANDS, 'p_partkey // 17 + p_size')} AS description,
    p_partkey % 4 = 0 AS sec_co
  FROM part),
title AS (
  SELECT *, {word_text("replace(title, '&', ' and ')")} || ' ' AS t FROM raw_title)
"""

TEXTS = f"""
doc AS (
  SELECT doc_id, source, text || chr(10) || {pick(b.DEMANDS, 'doc_id')} || chr(10)
    || {pick(b.SECRETS, 'doc_id')} AS text
  FROM documents)
"""

SCANS = f"""
scan AS (
  SELECT user_id || '-' || event_type AS listing_id, 'b' || (user_id % 10) AS board,
    event_id, ts, CAST(ts AS DATE) AS day, user_id, event_type, value,
    (day(ts) + user_id % 10) % 9 <> 0 AS scan_ok,
    {pick(['intern', 'newgrad', 'earlycareer'], 'user_id')} AS type
  FROM events),
seen AS (SELECT DISTINCT listing_id, board, day FROM scan WHERE scan_ok),
scan_day AS (SELECT DISTINCT board, day FROM scan WHERE scan_ok),
gap0 AS (
  SELECT *, lead(day) OVER (PARTITION BY listing_id ORDER BY day) AS next_day,
    CASE WHEN board IN ('b0', 'b5') THEN 14 ELSE 3 END AS grace
  FROM seen WHERE day <= DATE '{b.EVT_AS_OF}'),
gap1 AS (
  SELECT g.listing_id, g.board, g.day, g.next_day, g.grace, min(s.day) AS scan
  FROM gap0 g LEFT JOIN scan_day s ON s.board = g.board AND s.day >= g.day + g.grace
    AND s.day <= DATE '{b.EVT_AS_OF}'
  GROUP BY ALL),
gap AS (
  SELECT listing_id, board, day, next_day,
    CASE WHEN scan < next_day OR next_day IS NULL THEN scan END AS closed_on
  FROM gap1)
"""

CHECKS = """
checked AS (
  SELECT CAST(user_id AS VARCHAR) AS listing_id, ts,
    CASE WHEN event_type = 'error' THEN 'gone' WHEN event_type = 'signup' THEN 'soft_gone'
      WHEN user_id % 2 = 0 THEN 'ok' ELSE 'gone' END AS outcome
  FROM events),
probe AS (
  SELECT listing_id, CAST(ts AS DATE) AS probe_date, max_by(outcome, (ts, outcome)) AS outcome
  FROM checked GROUP BY 1, 2),
run0 AS (
  SELECT *, sum(CASE WHEN outcome = 'ok' THEN 1 ELSE 0 END)
    OVER (PARTITION BY listing_id ORDER BY probe_date) AS island FROM probe),
streak AS (
  SELECT listing_id, probe_date, outcome,
    row_number() OVER w AS streak,
    sum(CASE WHEN outcome = 'soft_gone' THEN 1 ELSE 0 END) OVER w AS soft
  FROM run0 WHERE outcome <> 'ok'
  WINDOW w AS (PARTITION BY listing_id, island ORDER BY probe_date))
"""

MARKS = """
mark AS (
  SELECT user_id, CAST(event_id AS VARCHAR) AS listing_id FROM events WHERE event_type = 'click')
"""


def _param(name: str) -> str:
    raw = f"regexp_extract(url, '^[^?#]*\\?(?:[^#]*?&)?{name}=([^&#]*)', 1)"
    return f"url_decode(replace({raw}, '+', ' '))"


SHARED = f"""
shared AS (
  SELECT page_id AS view_id, split_part(url, '#', 1)
    || CASE WHEN contains(split_part(url, '#', 1), '?') THEN '&' ELSE '?' END
    || {pick(['type=intern', 'type=newgrad', 'type=earlycareer', 'type=staff'], 'page_id')}
    || {pick(['&cat=1-urgent,5-low', '&cat=2-high,unknown', ''], 'page_id')}
    || {pick(['&q=small+ring', '&q=red%20wid', '&q=C%23,c%2B%2B', '&q=co1', ''], 'page_id')}
    || {pick(['&state=remote', '&state=AL', '&state=ZZ', '&state=CO', '', '', ''], 'page_id')}
    || {pick(['&days=7', '&days=30', '&days=9', '', '', ''], 'page_id')}
    || {pick(['&noclear=1', ''], 'page_id')}
    || {pick(['&closed=1', '', '', '', '', '', '', '', ''], 'page_id')}
    || {pick(['&sort=company'] + [''] * 10, 'page_id')} || '#top' AS url
  FROM pages),
known AS (
  SELECT (SELECT list(DISTINCT {slug('o_orderpriority')}) FROM orders) AS slugs,
    (SELECT list(DISTINCT coalesce(({lst(b.STATE_CODES)})[n_nationkey + 1], n_name))
     FROM supplier JOIN nation ON s_nationkey = n_nationkey) AS places),
view AS (
  SELECT view_id,
    CASE WHEN {_param('type')} IN ('intern', 'newgrad', 'earlycareer') THEN {_param('type')}
      ELSE 'intern' END AS type,
    substring({_param('q')}, 1, 120) AS q,
    list_filter(string_split({_param('cat')}, ','),
      lambda c: list_contains(slugs, c)) AS cat,
    CASE WHEN {_param('state')} = 'remote' OR list_contains(places,
      {_param('state')}) THEN {_param('state')} ELSE '' END AS state,
    CASE WHEN {_param('days')} IN ('7', '30') THEN {_param('days')} ELSE '' END AS days,
    {_param('noclear')} = '1' AS noclear,
    {_param('closed')} = '1' AS closed,
    CASE WHEN {_param('sort')} = 'company' THEN 'company' ELSE '' END AS sort
  FROM shared, known)
"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"
