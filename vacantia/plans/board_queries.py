"""Queries over the listing binding: projections, filters, sorts, counts, joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacantia.dims import CATEGORIES as LEGEND
from vacantia.functions import text
from vacantia.functions.dates import iso
from vacantia.operators import counts, filters, joins, prepare, repeats, sets, sketches, sorts
from vacantia.operators.filters import View
from vacantia.plans.bindings import CATEGORIES, LST_AS_OF
from vacantia.plans.catalog import query
from vacantia.plans.oracle import EMPLOYERS, LISTINGS, MARKS, POSTINGS, STATE_MAP, lst, q, with_
from vacantia.plans.oracle import slug as sql_slug
from vacantia.plans.oracle import word_text as sql_words
from vacantia.session import fixed_table, stored

BOARD = with_(LISTINGS)
AS_OF = f"DATE '{LST_AS_OF}'"

#: The view most queries use: word, categories, recency, no clearance.
SEARCH = View(type="newgrad", q="Ring re", cat=("1-urgent", "5-low"), days="30", noclear=True)
NARROW = View(type="intern", q="co1 remote", cat=("1-urgent",), state="remote", days="30")

_PASSES = "NOT closed AND NOT clearance AND age <= 30 AND contains(hay, ' ring') AND contains(hay, ' re')"
_NARROW = (
    "NOT closed AND remote AND age <= 30 AND contains(hay, ' co1') AND contains(hay, ' remote')"
)


def _dated(frame, *columns):
    return frame.select(
        *[iso(F.col(c)).alias(c) if c in ("date_added", "closed_date") else c for c in columns]
    )


# --- projections ------------------------------------------------------------------------


@query(
    "prj1_prepare",
    BOARD + "SELECT id, slug, age, hay FROM board",
)
def _(d):
    return d.board("role", "places").select("id", "slug", "age", "hay")


@query("prj2_age", BOARD + "SELECT age, count(*) AS n FROM board GROUP BY age")
def _(d):
    return d.board().groupBy("age").agg(F.count(F.lit(1)).alias("n"))


@query(
    "prj3_slug",
    f"""WITH c AS (SELECT o_orderpriority AS name FROM orders UNION ALL SELECT p_name FROM part
    UNION ALL SELECT * FROM (VALUES {', '.join(f'({q(c)})' for c in LEGEND)}) v(name))
    SELECT name, {sql_slug('name')} AS slug, count(*) AS n FROM c GROUP BY name""",
)
def _(d):
    legend = joins.categories(d.spark).select(F.col("category").alias("name"))
    names = (
        d.table("orders").select(F.col("o_orderpriority").alias("name"))
        .unionByName(d.table("part").select(F.col("p_name").alias("name")))
        .unionByName(legend)
    )
    counted = names.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("name", text.slug(F.col("name")).alias("slug"), "n")


@query("prj4_search_text", BOARD + "SELECT id, hay FROM board")
def _(d):
    return d.board("role", "places").select("id", "hay")


@query(
    "prj5_locations",
    BOARD + """SELECT id, CASE WHEN len(locations) > 1 THEN locations[1]
      WHEN location = '' THEN 'United States' ELSE location END AS "primary",
      CAST(greatest(0, len(locations) - 1) AS INTEGER) AS n_more,
      array_to_string(locations, ';') AS places FROM listing""",
)
def _(d):
    split = prepare.locations(d.listings("places").drop("locations"))
    return split.select("id", "primary", "n_more", F.array_join("locations", ";").alias("places"))


@query(
    "prj6_explode_places",
    BOARD + """SELECT id, unnest(CASE WHEN len(locations) = 0 THEN [NULL] ELSE locations END) AS place
      FROM listing""",
)
def _(d):
    return prepare.explode_places(d.listings("places"))


@query(
    "prj7_is_new",
    BOARD + "SELECT type, age, NOT closed AND age <= 7 AS is_new, count(*) AS n FROM board GROUP BY ALL",
)
def _(d):
    marked = d.board().withColumn("is_new", prepare.is_new())
    return marked.groupBy("type", "age", "is_new").agg(F.count(F.lit(1)).alias("n"))


# --- filters ----------------------------------------------------------------------------


def _filter(name: str, condition, where: str, *need: str):
    @query(name, BOARD + f"SELECT id, type, company FROM board WHERE {where}")
    def _(d):
        return d.board(*need).where(condition()).select("id", "type", "company")


_filter("flt1_type_tab", lambda: filters.of_type("newgrad"), "type = 'newgrad'")
_filter(
    "flt2_word_prefix_search", lambda: filters.search("rIng  Réd"),
    "contains(hay, ' ring') AND contains(hay, ' red')", "role", "places",
)
_filter(
    "flt3_categories", lambda: filters.in_categories(("2-high", "5-low")), "slug IN ('2-high', '5-low')"
)
_filter("flt4_place", lambda: filters.in_place("AL"), "list_contains(states, 'AL')", "places")
_filter("flt4_remote", lambda: filters.in_place("remote"), "remote", "places")
_filter("flt5_recency", lambda: filters.added_within(7, LST_AS_OF), "age <= 7")
_filter("flt6_no_clearance", lambda: filters.no_clearance(), "NOT clearance", "clearance")
_filter("flt7_open_only", lambda: filters.open_only(), "NOT closed")


@query(
    "flt8_board_view",
    BOARD + f"""SELECT id, company, role, category, location, CAST(date_added AS VARCHAR) AS date_added, age
      FROM board WHERE type = 'newgrad' AND {_PASSES} AND slug IN ('1-urgent', '5-low')""",
)
def _(d):
    shown = filters.board_view(d.board("role", "places", "clearance"), SEARCH, LST_AS_OF)
    return _dated(shown, "id", "company", "role", "category", "location", "date_added", "age")


# --- sorts ------------------------------------------------------------------------------


@query(
    "srt1_newest_first",
    BOARD + "SELECT id, closed, CAST(date_added AS VARCHAR) AS date_added, company FROM board",
)
def _(d):
    return _dated(sorts.newest_first(d.board()), "id", "closed", "date_added", "company")


@query(
    "srt2_company",
    BOARD + "SELECT id, company, CAST(date_added AS VARCHAR) AS date_added FROM board",
)
def _(d):
    return _dated(sorts.company_a_to_z(d.board()), "id", "company", "date_added")


@query(
    "srt3_published_open",
    BOARD + """SELECT type, CAST(date_added AS VARCHAR) AS date_added, company, id FROM board
      WHERE NOT closed""",
)
def _(d):
    return _dated(sorts.published_open(d.board()), "type", "date_added", "company", "id")


@query(
    "srt4_published_closed",
    BOARD + """SELECT type, CAST(closed_date AS VARCHAR) AS closed_date, company, id FROM board
      WHERE closed""",
)
def _(d):
    return _dated(sorts.published_closed(d.board()), "type", "closed_date", "company", "id")


_PIVOT = """SELECT company,
      nullif(count(*) FILTER (WHERE type = 'intern'), 0) AS intern,
      nullif(count(*) FILTER (WHERE type = 'newgrad'), 0) AS newgrad,
      nullif(count(*) FILTER (WHERE type = 'earlycareer'), 0) AS earlycareer
    FROM listing WHERE NOT closed GROUP BY company"""


@query("srt5_hiring_order", BOARD + _PIVOT)
def _(d):
    return sorts.hiring_order(counts.hiring_pivot(d.listings()))


@query(
    "srt6_employer_directory",
    with_(EMPLOYERS) + "SELECT DISTINCT platform, name, security_company FROM employer",
)
def _(d):
    return sorts.employer_directory(d.employers())


@query(
    "srt7_first_boards",
    with_(EMPLOYERS) + """SELECT platform, name, board_key, n FROM (SELECT *, CAST(row_number() OVER
      (PARTITION BY platform ORDER BY lower(name), name, board_key) AS INTEGER) AS n
      FROM (SELECT platform, name, board_key FROM employer)) WHERE n <= 3""",
)
def _(d):
    return sorts.first_boards(d.employers(), 3).select("platform", "name", "board_key", "n")


# --- counts -----------------------------------------------------------------------------

_TYPES = "(SELECT unnest(['intern', 'newgrad', 'earlycareer']) AS type)"


def _tabs(where: str) -> str:
    return (
        f"SELECT x.type, count(board.id) AS n FROM {_TYPES} x LEFT JOIN board "
        f"ON board.type = x.type AND {where} GROUP BY x.type"
    )


@query("agg1_tab_counts", BOARD + _tabs(f"{_PASSES} AND slug IN ('1-urgent', '5-low')"))
def _(d):
    return counts.tab_counts(d.board("role", "places", "clearance"), SEARCH, LST_AS_OF)


@query(
    "agg2_facet_counts",
    BOARD + f"""SELECT category, slug, count(*) FILTER (WHERE type = 'newgrad' AND {_PASSES}) AS n,
      CAST(list_position({lst(CATEGORIES)}, category) AS INTEGER) AS ordinal
      FROM board GROUP BY category, slug""",
)
def _(d):
    return counts.facet_counts(d.board("role", "places", "clearance"), SEARCH, LST_AS_OF, CATEGORIES)


_HIDDEN = "NOT EXISTS (SELECT 1 FROM mark WHERE user_id = 8 AND listing_id = board.id)"


def _applied(d):
    return d.marks().where("user_id = 8").select("listing_id")


@query(
    "agg1_tab_counts_hidden",
    with_(LISTINGS, MARKS) + _tabs(f"{_PASSES} AND slug IN ('1-urgent', '5-low') AND {_HIDDEN}"),
)
def _(d):
    board = d.board("role", "places", "clearance")
    return counts.tab_counts(board, SEARCH, LST_AS_OF, _applied(d))


@query(
    "agg2_facet_counts_hidden",
    with_(LISTINGS, MARKS) + f"""SELECT category, slug,
      count(*) FILTER (WHERE type = 'newgrad' AND {_PASSES} AND {_HIDDEN}) AS n,
      CAST(list_position({lst(CATEGORIES)}, category) AS INTEGER) AS ordinal
      FROM board GROUP BY category, slug""",
)
def _(d):
    board = d.board("role", "places", "clearance")
    return counts.facet_counts(board, SEARCH, LST_AS_OF, CATEGORIES, _applied(d))


@query(
    "agg4_other_tab_hint_hidden",
    with_(LISTINGS, MARKS) + f"""SELECT CASE type WHEN 'intern' THEN 'newgrad' ELSE type END AS type,
      count(*) AS n FROM board WHERE {_NARROW} AND slug = '1-urgent' AND {_HIDDEN} GROUP BY 1""",
)
def _(d):
    moved = F.expr("CASE WHEN type = 'intern' AND slug = '1-urgent' THEN 'newgrad' ELSE type END")
    board = d.board("role", "places").withColumn("type", moved)
    return counts.other_tab_hint(board, NARROW, LST_AS_OF, _applied(d))


@query(
    "agg3_shown_of_total",
    BOARD + f"""SELECT count(*) FILTER (WHERE {_PASSES} AND slug IN ('1-urgent', '5-low')) AS shown,
      count(*) AS total FROM board WHERE type = 'newgrad' AND NOT closed""",
)
def _(d):
    return counts.shown_of_total(d.board("role", "places", "clearance"), SEARCH, LST_AS_OF)


@query(
    "agg4_other_tab_hint",
    BOARD + f"""SELECT CASE type WHEN 'intern' THEN 'newgrad' ELSE type END AS type, count(*) AS n
      FROM board WHERE {_NARROW} AND slug = '1-urgent' GROUP BY 1""",
)
def _(d):
    """The active tab's rows of the one category asked for sit in another tab."""
    moved = F.expr("CASE WHEN type = 'intern' AND slug = '1-urgent' THEN 'newgrad' ELSE type END")
    return counts.other_tab_hint(d.board("role", "places").withColumn("type", moved), NARROW, LST_AS_OF)


@query(
    "agg5_summary",
    BOARD + """SELECT count(*) AS open_rows, count(*) FILTER (WHERE age <= 7) AS new_rows,
      count(DISTINCT company) AS companies FROM board WHERE NOT closed""",
)
def _(d):
    return counts.summary(d.board())


@query(
    "agg5_sketched_companies",
    BOARD + f"""SELECT x.type, s.span, count(DISTINCT company) AS companies, TRUE AS within_error
      FROM board x, (VALUES (7), (30), (90)) s(span) WHERE age < s.span GROUP BY 1, 2
      UNION ALL SELECT 'all', s.span, count(DISTINCT company), TRUE
      FROM board x, (VALUES (7), (30), (90)) s(span) WHERE age < s.span GROUP BY 2""",
)
def _(d):
    """Employers of the last days by stored sketches, two landings folded, beside the exact counts."""
    board = d.board().select("id", "type", "company", "date_added", "age")
    late = F.pmod(F.xxhash64("id"), F.lit(2)) == 0
    # Rows of one day land in two runs; some of the first land again.
    first, second = board.where(~late), board.where(late | (F.col("type") == "intern"))
    days = stored(sketches.day_sketches(first, "company", "date_added", ("type",)), "day-sketches")
    days = stored(
        sketches.fold(days, sketches.day_sketches(second, "company", "date_added", ("type",))), "day-sketches"
    )
    kinds = F.explode(F.array("type", F.lit("all"))).alias("type")

    def spans(age):
        """Every span that an age is in."""
        return F.explode(F.filter(F.array(*map(F.lit, (7, 30, 90))), lambda span: span > age)).alias("span")

    ages = F.datediff(F.lit(LST_AS_OF).cast("date"), F.col("day"))
    covered = days.select(kinds, "day", "sketch").select("type", spans(ages), "sketch")
    exact = board.select(kinds, "company", "age").select("type", spans(F.col("age")), "company").distinct()
    return sketches.estimates(covered, ("type", "span")).join(
        exact.groupBy("type", "span").agg(F.count("company").alias("companies")), ["type", "span"]
    ).select("type", "span", "companies", sketches.close_to(F.col("estimate"), F.col("companies")).alias("within_error"))


@query(
    "agg6_headline",
    BOARD + f"""SELECT count(*) FILTER (WHERE type = 'intern') AS intern,
      count(*) FILTER (WHERE type = 'newgrad') AS newgrad,
      count(*) FILTER (WHERE type = 'earlycareer') AS earlycareer,
      count(*) FILTER (WHERE age <= 7) AS new_rows, count(*) FILTER (WHERE clearance) AS clearance_rows,
      '{LST_AS_OF}' AS updated FROM board WHERE NOT closed""",
)
def _(d):
    return counts.headline(d.board("clearance"), LST_AS_OF)


_PULSE = f"""days AS (SELECT CAST({AS_OF} - i AS DATE) AS day, i AS age
    FROM (SELECT unnest(range(30))::INTEGER AS i)),
  pulse AS (SELECT days.day, days.age, count(board.id) AS n FROM days LEFT JOIN board
    ON board.age = days.age AND NOT closed GROUP BY ALL)"""


@query(
    "agg7_pulse",
    with_(LISTINGS, _PULSE) + "SELECT CAST(day AS VARCHAR) AS day, age, n FROM pulse",
)
def _(d):
    return counts.pulse(d.board(), LST_AS_OF).withColumn("day", iso(F.col("day")))


@query(
    "agg8_pulse_peak",
    with_(LISTINGS, _PULSE) + """SELECT greatest(1, max(n)) AS peak,
      CAST(max(day) FILTER (WHERE n = (SELECT max(n) FROM pulse) AND n > 0) AS VARCHAR) AS peak_day,
      CAST(sum(n) AS BIGINT) AS total,
      coalesce(min(age) FILTER (WHERE n = (SELECT max(n) FROM pulse) AND n > 0) <= 7, FALSE) AS recent
      FROM pulse""",
)
def _(d):
    peak = counts.pulse_peak(counts.pulse(d.board(), LST_AS_OF))
    return peak.withColumn("peak_day", iso(F.col("peak_day")))


@query("agg9_hiring_pivot", BOARD + _PIVOT)
def _(d):
    return counts.hiring_pivot(d.listings())


@query(
    "agg10_boards_per_platform",
    with_(EMPLOYERS) + """SELECT platform, count(DISTINCT name) AS employers FROM employer
      GROUP BY ROLLUP (platform)""",
)
def _(d):
    return counts.boards_per_platform(d.employers())


@query(
    "agg11_closed_counts",
    BOARD + f"""SELECT x.type, count(listing.id) AS n FROM {_TYPES} x LEFT JOIN listing
      ON listing.type = x.type AND closed AND {AS_OF} - closed_date <= 60 GROUP BY x.type""",
)
def _(d):
    return counts.closed_counts(d.listings(), LST_AS_OF)


@query(
    "agg12_place_options",
    BOARD + f"""SELECT DISTINCT code, coalesce(({STATE_MAP})[code], code) AS name
      FROM (SELECT unnest(states) AS code FROM listing)""",
)
def _(d):
    return counts.place_options(d.board("places"))


# --- joins ------------------------------------------------------------------------------


@query(
    "joi1_postings_with_board",
    with_(LISTINGS, EMPLOYERS, POSTINGS) + """SELECT p.id, p.platform, p.board_key, e.name,
      e.security_company, array_to_string(e.apply_hosts, ';') AS hosts
      FROM posting p JOIN employer e USING (platform, board_key)""",
)
def _(d):
    joined = joins.with_board(d.postings(), d.employers())
    return joined.select(
        "id", "platform", "board_key", "name", "security_company",
        F.array_join("apply_hosts", ";").alias("hosts"),
    )


@query(
    "joi2_hide_applied",
    with_(LISTINGS, MARKS) + """SELECT id, type, company FROM listing WHERE NOT EXISTS
      (SELECT 1 FROM mark WHERE user_id = 8 AND listing_id = id)""",
)
def _(d):
    return joins.hide_applied(d.listings(), d.marks(), 8).select("id", "type", "company")


@query(
    "joi3_applied_flag",
    with_(LISTINGS, MARKS) + """SELECT id, EXISTS (SELECT 1 FROM mark WHERE user_id = 8
      AND listing_id = id) AS applied FROM listing""",
)
def _(d):
    return joins.with_applied(d.listings(), d.marks(), 8).select("id", "applied")


@query(
    "joi3_applied_only",
    with_(LISTINGS, MARKS) + """SELECT id, company FROM listing WHERE id IN
      (SELECT listing_id FROM mark WHERE user_id = 8)""",
)
def _(d):
    return joins.applied_only(d.listings(), d.marks(), 8).select("id", "company")


@query(
    "joi5_state_names",
    BOARD + f"""SELECT id, place, coalesce(({STATE_MAP})[place], place) AS place_name
      FROM (SELECT id, unnest(states) AS place FROM listing)""",
)
def _(d):
    bridge = prepare.explode_places(d.listings("places"), "states").where("place IS NOT NULL")
    return joins.with_state_names(bridge, joins.states(d.spark))


@query(
    "joi6_category_legend",
    BOARD + f"""SELECT listing.id, v.ordinal, v.description FROM listing LEFT JOIN
      (VALUES {', '.join(f'({i + 1}, {q(c)}, {q(c.lower())})' for i, c in enumerate(CATEGORIES))})
      v(ordinal, category, description) USING (category)""",
)
def _(d):
    rows = [(i + 1, c, c.lower()) for i, c in enumerate(CATEGORIES)]
    dim = fixed_table(d.spark, rows, "ordinal, category, description")
    return joins.with_category_text(d.listings(), dim).select("id", "ordinal", "description")


@query(
    "joi8_untracked",
    with_(LISTINGS, EMPLOYERS) + """SELECT id, company FROM listing
      WHERE company NOT IN (SELECT name FROM employer)""",
)
def _(d):
    return joins.untracked(d.listings(), d.employers()).select("id", "company")


@query(
    "joi9_silent_boards",
    with_(LISTINGS, EMPLOYERS, POSTINGS) + """SELECT platform, board_key, name FROM employer e
      WHERE NOT EXISTS (SELECT 1 FROM posting p WHERE p.platform = e.platform
        AND p.board_key = e.board_key AND p.n % 10 <> 3)""",
)
def _(d):
    """Every tenth employer's postings land under a board that is not configured."""
    old = F.concat("board_key", F.lit("-old"))
    landed = d.postings().withColumn(
        "board_key", F.when(F.endswith("company", F.lit("3")), old).otherwise(F.col("board_key"))
    )
    return joins.silent_boards(d.employers(), landed).select("platform", "board_key", "name")


_DUP_KEY = f"""dup AS (SELECT id, company, {sql_words('role')} AS role_key,
    array_to_string(locations, ';') AS place_key FROM listing)"""


@query(
    "joi10_duplicate_groups",
    with_(LISTINGS, _DUP_KEY) + """SELECT company, role_key, place_key, count(*) AS n,
      min(id) AS keep_id FROM dup GROUP BY ALL HAVING count(*) > 1""",
)
def _(d):
    return joins.duplicate_groups(d.listings("role", "places"))


@query(
    "joi10_without_duplicates",
    with_(LISTINGS, _DUP_KEY) + """SELECT min(id) AS id, company FROM dup
      GROUP BY company, role_key, place_key""",
)
def _(d):
    return joins.drop_duplicates(d.listings("role", "places")).select("id", "company")


# --- windows ----------------------------------------------------------------------------


def _repeat_sql(partition: str, order: str, same: str) -> str:
    return BOARD + f"""SELECT id, coalesce({same}, FALSE) AS is_repeat FROM (SELECT *,
      lag(company) OVER w AS p_company, lag(date_added) OVER w AS p_date FROM board
      WINDOW w AS (PARTITION BY {partition} ORDER BY {order}))"""


@query(
    "win1_page_repeats",
    _repeat_sql(
        "type", "closed, date_added DESC, lower(strip_accents(company)), company, id",
        "p_company = company",
    ),
)
def _(d):
    return repeats.newest_first(d.board()).select("id", "is_repeat")


@query(
    "win1_company_repeats",
    _repeat_sql(
        "type", "lower(strip_accents(company)), date_added DESC, company, id",
        "p_company = company",
    ),
)
def _(d):
    return repeats.company_a_to_z(d.board()).select("id", "is_repeat")


@query(
    "win2_table_repeats",
    _repeat_sql(
        "type, closed", "date_added DESC, lower(strip_accents(company)), company, id",
        "p_company = company AND p_date = date_added",
    ),
)
def _(d):
    return repeats.published(d.board()).select("id", "is_repeat")


# --- sets -------------------------------------------------------------------------------


@query(
    "set1_union_sources",
    BOARD + """SELECT id, company, source, CASE WHEN source = 'board' THEN category END AS category
      FROM listing""",
)
def _(d):
    rows = d.listings()
    scraped = rows.where("source = 'board'").select("id", "company", "category")
    community = rows.where("source = 'community'").select("id", "company")
    return sets.union_sources(scraped, community)


@query(
    "flagship_search",
    BOARD + f"""SELECT slug, count(*) FILTER (WHERE {_PASSES}) AS matches,
      count(*) FILTER (WHERE NOT closed AND age <= 7) AS fresh,
      count(DISTINCT company) AS companies FROM board GROUP BY slug""",
)
def _(d):
    board = d.board("role", "places", "clearance")
    return board.groupBy("slug").agg(
        F.count_if(filters.passes(SEARCH, LST_AS_OF)).alias("matches"),
        F.count_if(prepare.is_new()).alias("fresh"),
        F.countDistinct("company").alias("companies"),
    )


