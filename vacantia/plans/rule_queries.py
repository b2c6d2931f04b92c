"""Queries over the title and text bindings: one per rule, and the full verdicts."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacantia.functions.text import title_text
from vacantia.operators import counts, sets
from vacantia.plans import rule_sql as r
from vacantia.plans.bindings import RULES, TTL_AS_OF
from vacantia.plans.catalog import query
from vacantia.plans.oracle import TEXTS, TITLES, fold, q, with_
from vacantia.rules import classify as cls
from vacantia.rules import experience, hits, level, rejects, roles, usplaces
from vacantia.rules import lexicon as lex
from vacantia.session import fixed_table, stored

TTL = with_(TITLES)


def _titles(d):
    return d.titles().withColumn("t", title_text(F.col("title")))


def _flag(name: str, column, sql: str, alias: str = "flag"):
    @query(name, TTL + f"SELECT posting_id, title, {sql} AS {alias} FROM title")
    def _(d):
        return _titles(d).select("posting_id", "title", column(F.col("t"), F.col("sec_co")).alias(alias))


_flag("cls1_security_term", lambda t, s: roles.is_security_term(t), r.CORE)
_flag("cls2_ops_grc_term", lambda t, s: roles.is_ops_grc_term(t), r.OPS)
_flag("cls3_other_sense", lambda t, s: roles.other_sense(t), r.SENSE, "sense")
_flag("cls4_product_role", lambda t, s: roles.is_product_role(t), r.PRODUCT)
_flag("cls5_team_engineer", lambda t, s: roles.is_team_engineer(t), r.TEAM)
_flag("cls6_cloud_role", lambda t, s: roles.is_cloud_role(t), r.CLOUD)
_flag("cls7_solutions_role", lambda t, s: roles.is_solutions_role(t, s), r.SOLUTIONS)
_flag("cls8_weak_noun", lambda t, s: roles.weak_noun(t), r.WEAK, "why")
_flag("cls9_sec_company_role", lambda t, s: roles.sec_company_role(t, s), r.SEC_CO)
_flag(
    "cls11_level_from_title", lambda t, s: level.level_from_title(t, TTL_AS_OF),
    r.level(TTL_AS_OF), "type",
)

FLAGS = f"""flags AS (SELECT *, {r.SECURE} AS secure, {r.CLOUD} AS cloud, {r.SOLUTIONS} AS solutions,
    {r.SEC_CO} AS at_sec_co, {r.SPAN} AS spans, {r.level(TTL_AS_OF)} AS title_level FROM title)"""
_FACTS = r.facts("title", "posting_id", "description")


@query(
    "cls10_category",
    with_(TITLES, FLAGS) + f"SELECT posting_id, title, {r.CATEGORY} AS category FROM flags",
)
def _(d):
    t, s = F.col("t"), F.col("sec_co")
    staged = _titles(d).withColumns(
        {
            "secure": roles.names_security(t),
            "cloud": roles.is_cloud_role(t),
            "solutions": roles.is_solutions_role(t, s),
            "at_sec_co": roles.sec_company_role(t, s),
        }
    )
    flags = [F.col(c) for c in ("secure", "cloud", "solutions", "at_sec_co")]
    return staged.select("posting_id", "title", cls.category(t, s, *flags).alias("category"))


@query(
    "cls12_multi_level",
    with_(TITLES, _FACTS) + f"""SELECT posting_id, title, {r.SPAN} AS spans,
      NOT {r.SPAN} OR coalesce(floor <= 2, FALSE) AS ok FROM title JOIN fact USING (posting_id)""",
)
def _(d):
    floor = experience.years_floor(F.col("description"))
    return _titles(d).withColumn("floor", floor).select(
        "posting_id", "title", rejects.is_multi_level(F.col("t")).alias("spans"),
        level.multi_level_ok(F.col("t"), F.col("floor")).alias("ok"),
    )


@query(
    "cls13_level_from_posting",
    with_(TITLES, _FACTS) + f"""SELECT posting_id, title, {r.POSTING_LEVEL} AS type
      FROM title JOIN fact USING (posting_id)""",
)
def _(d):
    staged = _titles(d).withColumn("facts", experience.facts(F.col("description")))
    found = level.level_from_posting(F.col("t"), F.col("sec_co"), F.col("facts"))
    return staged.select("posting_id", "title", found.alias("type"))


@query(
    "cls14_years_floor",
    with_(TEXTS, r.facts("doc", "doc_id", "text")) + """SELECT doc_id, CAST(floor AS INTEGER) AS floor,
      CAST(highest AS INTEGER) AS highest, ceiling, says_early, says_newgrad FROM fact""",
)
def _(d):
    return d.texts().select("doc_id", experience.facts(F.col("text")).alias("f")).select(
        "doc_id", "f.*"
    )


@query(
    "cls15_reject_reason",
    with_(TITLES, FLAGS) + f"SELECT posting_id, title, {r.REJECT} AS reason FROM flags",
)
def _(d):
    staged = _titles(d).withColumn("secure", roles.names_security(F.col("t")))
    reason = rejects.reject_reason(F.col("t"), F.col("secure"), F.col("title"))
    return staged.select("posting_id", "title", reason.alias("reason"))


@query(
    "cls16_stale_season",
    with_(TITLES, FLAGS) + f"""SELECT posting_id, title, coalesce(title_level = 'intern', FALSE)
      AND {r.season_over(TTL_AS_OF)} AS stale FROM flags""",
)
def _(d):
    staged = _titles(d).withColumn("type", level.level_from_title(F.col("t"), TTL_AS_OF))
    stale = rejects.is_stale_season(F.col("t"), F.col("type"), TTL_AS_OF)
    return staged.select(
        "posting_id", "title", F.coalesce(stale, F.lit(False)).alias("stale")
    )


# What each location of the binding reads as: kept places, states, remote. Written by hand.
PLACE_ROWS = [
    ("Arlington, VA", "Arlington, VA", "VA", False),
    ("Arlington, Virginia", "Arlington, VA", "VA", False),
    ("Arlington VA", "Arlington, VA", "VA", False),
    ("Washington, D.C.", "Washington, DC", "DC", False),
    ("Hamburg, NY", "Hamburg, NY", "NY", False),
    ("Hamburg, New York", "", "", False),
    ("Remote (US)", "Remote (US)", "", True),
    ("Remote", "Remote (US)", "", True),
    ("United States", "United States", "", False),
    ("Remote (Europe)", "", "", False),
    ("London, UK; Remote", "", "", False),
    ("London, UK; Austin, TX", "Austin, TX", "TX", False),
    ("CA (US)", "CA", "CA", False),
    ("GA", "GA", "GA", False),
    ("Irving Texas United States", "Irving, TX", "TX", False),
    ("Remote, VA", "Remote, VA", "VA", True),
    ("Remote - CA", "Remote, CA", "CA", True),
    ("San Francisco, CA • New York, NY", "San Francisco, CA;New York, NY", "CA;NY", False),
    ("Sunnyvale, California - HQ", "Sunnyvale, CA", "CA", False),
    ("San Juan, Puerto Rico, PR", "San Juan, PR", "PR", False),
    ("", "", "", False),
    ("Toronto, Canada", "", "", False),
    ("WA - Seattle - Office", "Seattle, WA", "WA", False),
]
PLACE = "place(location, kept, states, remote) AS (VALUES {})".format(
    ", ".join(f"({q(a)}, {q(b)}, {q(c)}, {str(e).upper()})" for a, b, c, e in PLACE_ROWS)
)


@query(
    "cls17_us_places",
    with_(TITLES, PLACE) + "SELECT posting_id, kept AS locations, states FROM title JOIN place USING (location)",
)
def _(d):
    found = d.titles().withColumn("us", usplaces.us_places(F.col("location")))
    return found.select(
        "posting_id", F.array_join("us.locations", ";").alias("locations"),
        F.array_join("us.states", ";").alias("states"),
    )


@query(
    "cls18_remote_scope",
    with_(TITLES, PLACE) + "SELECT posting_id, location, remote FROM title JOIN place USING (location)",
)
def _(d):
    remote = usplaces.remote_scope(F.col("location"))
    return d.titles().select("posting_id", "location", remote.alias("remote"))


# Stated by hand for the endings that the sample titles have.
_ABROAD = """(regexp_matches(t, ' (uk|costa rica|london|bengaluru|mexico city) $')
    OR (contains(t, ' hamburg hybrid ') AND NOT starts_with(kept, 'Hamburg, ')))"""


@query(
    "cls19_drop_foreign",
    with_(TITLES, PLACE) + f"""SELECT posting_id, CASE WHEN {_ABROAD} THEN '' ELSE kept END AS locations
      FROM title JOIN place USING (location)""",
)
def _(d):
    kept = usplaces.drop_foreign(F.col("location"), F.col("t"))
    return _titles(d).select("posting_id", F.array_join(kept, ";").alias("locations"))


_CLEARANCE = (
    f"regexp_matches(regexp_replace(lower({{0}}), {q(experience.NO_CLEARANCE)}, ' ', 'g'),"
    f" {q(experience.CLEARANCE)})"
)


@query(
    "cls20_clearance",
    with_(TEXTS) + f"SELECT doc_id, {_CLEARANCE.format('text')} AS clearance FROM doc",
)
def _(d):
    return d.texts().select("doc_id", experience.clearance(F.col("text")).alias("clearance"))


@query(
    "cls21_verdict",
    with_(TITLES, FLAGS, PLACE) + f""", why AS (SELECT posting_id, list_filter([
        CASE WHEN NOT (secure OR cloud OR solutions OR at_sec_co) THEN 'role' END, {r.REJECT},
        CASE WHEN title_level IS NULL OR spans THEN 'level' END,
        CASE WHEN {_ABROAD} OR kept = '' THEN 'place' END,
        CASE WHEN title_level = 'intern' AND {r.season_over(TTL_AS_OF)} THEN 'season' END],
        lambda x: x IS NOT NULL) AS reasons FROM flags JOIN place USING (location))
      SELECT posting_id, CASE WHEN len(reasons) = 0 THEN 'valid' ELSE 'needs-fix' END AS label,
        array_to_string(reasons, ';') AS reasons FROM why""",
)
def _(d):
    return cls.verdict(d.titles(), TTL_AS_OF).select(
        "posting_id", "label", F.array_join("reasons", ";").alias("reasons")
    )


JUDGED = f"""judged0 AS (SELECT *, {r.REJECT} AS rejected, CASE
      WHEN title_level = 'intern' THEN 'intern'
      WHEN spans THEN CASE WHEN floor <= 2 THEN coalesce(title_level, 'earlycareer') END
      WHEN title_level IS NOT NULL THEN title_level
      ELSE {r.POSTING_LEVEL} END AS type, {r.CATEGORY} AS category
    FROM flags JOIN fact USING (posting_id) JOIN place USING (location)),
  judged AS (SELECT *, CASE WHEN NOT (secure OR cloud OR solutions OR at_sec_co) THEN 'role'
      WHEN rejected IS NOT NULL THEN rejected WHEN {_ABROAD} OR kept = '' THEN 'place'
      WHEN type IS NULL THEN 'level' WHEN type <> 'intern' AND coalesce(floor > 2, FALSE) THEN 'years'
      WHEN type = 'intern' AND {r.season_over(TTL_AS_OF)} THEN 'season' END AS reason FROM judged0),
  verdicts AS (SELECT posting_id, title, type, category, reason,
    CASE WHEN reason IS NULL THEN 'in' ELSE 'out' END AS verdict,
    {_CLEARANCE.format('description')} AS needs_clearance, kept, states, remote FROM judged)"""
_VERDICTS = with_(TITLES, FLAGS, _FACTS, PLACE, JUDGED)


@query(
    "cls_classify",
    _VERDICTS + """SELECT posting_id, verdict, reason, type, category, kept AS locations, states,
      remote, needs_clearance FROM verdicts""",
)
def _(d):
    return cls.classify(d.titles(), TTL_AS_OF).select(
        "posting_id", "verdict", "reason", "type", "category",
        F.array_join("us_locations", ";").alias("locations"),
        F.array_join("us_states", ";").alias("states"), F.col("us_remote").alias("remote"),
        "needs_clearance",
    )


@query(
    "agg14_verdict_counts",
    _VERDICTS + "SELECT verdict, reason, count(*) AS n FROM verdicts GROUP BY ALL",
)
def _(d):
    return counts.verdict_counts(cls.classify(d.titles(), TTL_AS_OF))


_HIT = " UNION ALL ".join(
    f"SELECT doc_id, {q(name)} AS rule, (length(tt) - length(replace(tt, {q(' ' + phrase + ' ')}, ''))) // "
    f"{len(phrase) + 2} AS n FROM tok"
    for name, phrase in ((n, p.replace("é", "e").replace(" ", "  ")) for n, p in RULES)
)


@query(
    "cls22_rule_hits",
    f"""WITH tok AS (SELECT doc_id, ' ' || replace(trim(regexp_replace({fold('text')},
        '[^a-z0-9+#]+', ' ', 'g')), ' ', '  ') || ' ' AS tt FROM documents)
      SELECT doc_id, rule, n FROM ({_HIT}) WHERE n > 0""",
)
def _(d):
    rules = fixed_table(d.spark, RULES, "rule, phrase")
    return hits.rule_hits(d.table("documents").select("doc_id", "text"), rules)


def _runs(d):
    """Two stored runs over all titles: some under another id in one of them, some judged anew."""
    judged = cls.classify(d.titles(), TTL_AS_OF)
    parts = stored(judged.select("posting_id", "title", "verdict", "type", "category"), "run")
    key = F.col("posting_id")
    before = parts.withColumn("posting_id", F.when(key % 11 == 0, -key).otherwise(key))
    kind = F.when(F.col("posting_id") % 5 == 0, F.lit("newgrad")).otherwise(F.col("type"))
    flipped = F.when(F.col("posting_id") % 7 == 0, F.lit("in")).otherwise(F.col("verdict"))
    own = F.when(key % 13 == 0, -key).otherwise(key)
    after = parts.withColumns({"type": kind, "verdict": flipped, "posting_id": own})
    return before, after


_RUNS = """old AS (SELECT CASE WHEN posting_id % 11 = 0 THEN -posting_id ELSE posting_id END AS posting_id,
    title, verdict, type, category FROM verdicts),
  new AS (SELECT CASE WHEN posting_id % 13 = 0 THEN -posting_id ELSE posting_id END AS posting_id, title, CASE WHEN posting_id % 7 = 0 THEN 'in' ELSE verdict END AS verdict,
    CASE WHEN posting_id % 5 = 0 THEN 'newgrad' ELSE type END AS type, category
    FROM verdicts)"""
_MOVE = """CASE WHEN o.{0} IS NULL THEN 'added' WHEN n.{0} IS NULL THEN 'removed'
    WHEN o.verdict <> n.verdict THEN o.verdict || '->' || n.verdict
    WHEN o.type IS DISTINCT FROM n.type THEN 'type' ELSE 'category' END"""
_CHANGED = """o.{0} IS NULL OR n.{0} IS NULL OR o.verdict <> n.verdict
    OR o.type IS DISTINCT FROM n.type OR o.category IS DISTINCT FROM n.category"""


@query(
    "set3_run_diff",
    with_(TITLES, FLAGS, _FACTS, PLACE, JUDGED, _RUNS) + f"""SELECT
      coalesce(o.posting_id, n.posting_id) AS posting_id, o.verdict AS old_verdict,
      n.verdict AS new_verdict, o.type AS old_type, n.type AS new_type, {_MOVE.format('posting_id')} AS move
      FROM old o FULL JOIN new n ON o.posting_id = n.posting_id WHERE {_CHANGED.format('posting_id')}""",
)
def _(d):
    before, after = _runs(d)
    return sets.run_diff(before, after, "posting_id").select(
        "posting_id", F.col("old.verdict").alias("old_verdict"),
        F.col("new.verdict").alias("new_verdict"), F.col("old.type").alias("old_type"),
        F.col("new.type").alias("new_type"), "move",
    )


_CORPUS = """corpus AS (SELECT title, max(verdict) AS verdict, max(type) AS type,
    max(category) AS category FROM verdicts GROUP BY title),
  oldc AS (SELECT * REPLACE (CASE WHEN length(title) % 9 = 0 THEN title || ' (old)' ELSE title END AS title)
    FROM corpus),
  newc AS (SELECT title, CASE WHEN length(title) % 10 = 3 THEN 'in' ELSE verdict END AS verdict, type,
    CASE WHEN length(title) % 10 = 4 THEN NULL ELSE category END AS category FROM corpus)"""


@query(
    "qlt4_corpus_diff",
    with_(TITLES, FLAGS, _FACTS, PLACE, JUDGED, _CORPUS) + f"""SELECT
      coalesce(o.title, n.title) AS title, {_MOVE.format('title')} AS move
      FROM oldc o FULL JOIN newc n ON o.title = n.title WHERE {_CHANGED.format('title')}""",
)
def _(d):
    """Two stored runs over all titles; in the earlier one some read otherwise."""
    judged = cls.classify(d.titles(), TTL_AS_OF)
    corpus = judged.groupBy("title").agg(
        F.max("verdict").alias("verdict"), F.max("type").alias("type"),
        F.max("category").alias("category"),
    )
    corpus = stored(corpus, "corpus")
    size, title = F.length("title"), F.col("title")
    earlier = F.when(size % 9 == 0, F.concat(title, F.lit(" (old)"))).otherwise(title)
    later = corpus.withColumns(
        {
            "verdict": F.when(size % 10 == 3, F.lit("in")).otherwise(F.col("verdict")),
            "category": F.when(size % 10 != 4, F.col("category")),
        }
    )
    return sets.run_diff(corpus.withColumn("title", earlier), later, "title").select("title", "move")
