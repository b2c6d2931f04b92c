"""Search text, filters, orders, counts and repeat markers on small boards."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from vacantia import schema
from vacantia.functions import text
from vacantia.operators import counts, filters, joins, prepare, publish, repeats, sorts, views
from vacantia.operators.filters import View

AS_OF = "2026-11-21"
TODAY = datetime.date(2026, 11, 21)


def listing(i, **given):
    row = dict.fromkeys(schema.LISTING.fieldNames())
    row.update(
        id=f"{i:04}", source="board", company="Acme", role="Analyst", type="intern",
        category="SOC & Detection", location="", states=[], url=f"https://x.example/{i}",
        date_added=TODAY,
    )
    row.update(given)
    return tuple(row[c] for c in schema.LISTING.fieldNames())


def board(spark, rows):
    return prepare.prepare(prepare.with_defaults(spark.createDataFrame(rows, schema.LISTING)), AS_OF)


def ids(frame):
    return [r["id"] for r in frame.collect()]


def test_word_prefix_search(spark):
    rows = [
        listing(1, role="Associate Developer"), listing(2, role="SOC Analyst"),
        listing(3, role="C# and C++ Developer"), listing(4, company="Café Ünï", role="Ingénieur"),
    ]
    found = board(spark, [r[:7] + ("GRC & Risk",) + r[8:] for r in rows])
    for query, want in [
        ("soc", ["0002"]), ("C#", ["0003"]), ("c++ dev", ["0003"]), ("cafe", ["0004"]),
        ("CAFÉ inge", ["0004"]), ("dev soc", []), ("", ["0001", "0002", "0003", "0004"]),
    ]:
        assert sorted(ids(found.where(filters.search(query)))) == want, query


def test_words_match_the_plan_time_form(spark):
    samples = ["Crème Brûlée C++", "ﬁne ½ Ⅳ ²", "İstanbul №5", "a™b", "ß Æ", "", "—"]
    frame = spark.createDataFrame([(s,) for s in samples], "s string")
    got = [r[0] for r in frame.select(text.words(F.col("s"))).collect()]
    assert got == [text.query_words(s) for s in samples]


@pytest.mark.parametrize(
    "name, want",
    [("SOC & Detection", "soc-and-detection"), ("Engineering @ Security Co", "engineering-security-co"),
     ("  A--b ", "a-b"), ("GRC & Risk", "grc-and-risk")],
)
def test_slug(spark, name, want):
    assert spark.range(1).select(text.slug(F.lit(name))).first()[0] == want


def test_age_and_recency(spark):
    day = datetime.timedelta(days=1)
    rows = [
        listing(1, date_added=TODAY + day), listing(2, date_added=TODAY - 7 * day),
        listing(3, date_added=TODAY - 8 * day),
    ]
    found = board(spark, rows)
    assert [r["age"] for r in found.orderBy("id").collect()] == [0, 7, 8]
    assert sorted(ids(found.where(filters.added_within(7, AS_OF)))) == ["0001", "0002"]
    last = counts.pulse(found, AS_OF).orderBy(F.desc("day")).first()
    assert (last["day"], last["n"]) == (TODAY, 1)


def test_pulse_of_nothing(spark):
    peak = counts.pulse_peak(counts.pulse(board(spark, []), AS_OF)).first()
    assert (peak["peak"], peak["peak_day"], peak["total"]) == (1, None, 0)


def test_pulse_tie_takes_the_latest_day(spark):
    rows = [listing(i, date_added=TODAY - datetime.timedelta(days=i % 3)) for i in range(6)]
    assert counts.pulse_peak(counts.pulse(board(spark, rows), AS_OF)).first()["peak_day"] == TODAY


def test_facets_leave_the_category_out(spark):
    rows = [listing(1), listing(2, category="GRC & Risk"), listing(3, category="Cloud Engineering", type="newgrad")]
    view = View(cat=("grc-and-risk",))
    order = ["GRC & Risk", "SOC & Detection", "Cloud Engineering", "Identity & IAM"]
    got = counts.facet_counts(board(spark, rows), view, AS_OF, order).collect()
    assert [(r["category"], r["n"]) for r in got] == [
        ("GRC & Risk", 1), ("SOC & Detection", 1), ("Cloud Engineering", 0),
    ]
    shown = counts.shown_of_total(board(spark, rows), view, AS_OF).first()
    assert (shown["shown"], shown["total"]) == (1, 2)
    marks = spark.createDataFrame([("0002",), ("0002",)], "listing_id string")
    shown = counts.shown_of_total(board(spark, rows), view, AS_OF, marks).first()
    assert (shown["shown"], shown["total"]) == (0, 2)
    assert ids(filters.board_view(board(spark, rows), view, AS_OF, marks)) == []


def test_locations(spark):
    rows = [
        listing(1, location="A, VA; B, NY ;"), listing(2, location=""), listing(3, location=None),
        listing(4, location="C, TX"),
    ]
    got = prepare.locations(board(spark, rows)).orderBy("id").collect()
    assert [(r["primary"], r["n_more"]) for r in got] == [
        ("A, VA", 1), ("United States", 0), ("United States", 0), ("C, TX", 0),
    ]


def test_orders(spark):
    day = datetime.timedelta(days=1)
    rows = [
        listing(1, company="beta"), listing(2, company="Álpha"), listing(3, company="alpha", closed=True),
        listing(4, company="Zed", date_added=TODAY - day), listing(5, company="BETA"),
    ]
    found = board(spark, rows)
    assert ids(sorts.newest_first(found)) == ["0002", "0005", "0001", "0004", "0003"]
    assert ids(sorts.company_a_to_z(found)) == ["0003", "0002", "0005", "0001", "0004"]


def random_board(seed, n=300):
    pick = random.Random(seed)
    names = ["Acme", "acme", "Beta", "Äcme", "Zed"]
    return [
        listing(
            i, company=pick.choice(names), type=pick.choice(["intern", "newgrad"]),
            date_added=TODAY - datetime.timedelta(days=pick.randrange(6)), closed=pick.random() < 0.3,
            states=pick.sample(["VA", "NY", "TX"], pick.randrange(3)), remote=pick.random() < 0.2,
            role=pick.choice(["SOC Analyst", "Go Developer", "IT Auditor"]),
            category=pick.choice(["SOC & Detection", "GRC & Risk"]), clearance=pick.random() < 0.3,
        )
        for i in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize(
    "order, mark", [(sorts.newest_first, repeats.newest_first), (sorts.company_a_to_z, repeats.company_a_to_z)]
)
def test_page_repeats_against_the_displayed_order(spark, seed, order, mark):
    found = board(spark, random_board(seed))
    flags = {r["id"]: r["is_repeat"] for r in mark(found).collect()}
    for kind in ("intern", "newgrad"):
        shown = order(found.where(F.col("type") == kind)).collect()
        for i, row in enumerate(shown):
            want = i > 0 and shown[i - 1]["company"] == row["company"]
            assert flags[row["id"]] is want, (kind, i)


def test_table_repeats(spark):
    found = board(spark, random_board(3)).where("NOT closed")
    flags = {r["id"]: r["is_repeat"] for r in repeats.published(found).collect()}
    for kind in ("intern", "newgrad"):
        shown = [r for r in sorts.published_open(found).collect() if r["type"] == kind]
        for i, row in enumerate(shown):
            above = shown[i - 1] if i else None
            want = above is not None and (above["company"], above["date_added"]) == (
                row["company"], row["date_added"],
            )
            assert flags[row["id"]] is want


VIEWS = [
    (1, "intern", "", [], "", "", False, False), (2, "intern", "soc an", [], "", "", True, False),
    (3, "newgrad", "", ["grc-and-risk", "soc-and-detection"], "VA", "", False, True),
    (4, "newgrad", "go", [], "remote", "7", False, False), (5, "intern", "", [], "NY", "30", False, False),
    (6, "intern", "it au", ["grc-and-risk"], "", "", False, True), (7, "intern", "SOC an", [], "", "", True, False),
    (8, "newgrad", "a", [], "", "", False, False), (9, "intern", "zzzz", [], "", "", False, False),
]


def test_saved_searches_against_each_view(spark):
    found = board(spark, random_board(4)).cache()
    saved = spark.createDataFrame(
        [v + ("",) for v in VIEWS],
        "view_id int, type string, q string, cat array<string>, state string, days string, "
        "noclear boolean, closed boolean, sort string",
    )
    pairs = views.saved_search_matches(saved, found, slice_rows=7).collect()
    assert len(pairs) == len(set(pairs))
    got = {}
    for r in pairs:
        got.setdefault(r["search_id"], set()).add(r["id"])
    for view_id, kind, q, cat, state, days, noclear, closed in VIEWS:
        if view_id == 7:  # the same search as 2, kept once
            assert 7 not in got
            continue
        view = View(kind, q, tuple(cat), state, days, noclear, closed)
        assert got.get(view_id, set()) == set(ids(found.where(filters.matches(view, AS_OF)))), view


def test_view_links(spark):
    links = spark.createDataFrame(
        [
            (1, "https://b.example/?type=staff&q=a%20b+c&cat=x,soc,soc&state=WY&days=9&noclear=1#q=z"),
            (2, "https://b.example/?sort=company&state=remote&days=30&closed=1&type=newgrad&q=%ZZ"),
            (3, "https://b.example/#type=newgrad"), (4, "https://b.example/?q=" + "y" * 130),
        ],
        "view_id int, url string",
    )
    known = F.array(F.lit("soc"), F.lit("grc"))
    got = views.normalize_views(links, known, F.array(F.lit("VA"))).orderBy("view_id").collect()
    assert [tuple(r)[1:] for r in got[:3]] == [
        ("intern", "a b c", ["soc", "soc"], "", "", True, False, ""),
        ("newgrad", "%ZZ", [], "remote", "30", False, True, "company"),
        ("intern", "", [], "", "", False, False, ""),
    ]
    assert len(got[3]["q"]) == 120
    shown = views.normalize_views(links, known, F.array(F.lit("VA"))).select(
        "view_id", views.canonical_view().alias("v"), views.active_filters().alias("n")
    ).orderBy("view_id").collect()
    assert [(r["v"], r["n"]) for r in shown[:3]] == [
        ("q=a+b+c&cat=soc,soc&noclear=1", 3),
        ("type=newgrad&q=%25ZZ&state=remote&days=30&closed=1&sort=company", 3), ("", 0),
    ]


def test_duplicates_keep_the_lowest_id(spark):
    rows = [listing(2, role="SOC  Analyst"), listing(1, role="soc analyst"), listing(3, role="Other")]
    found = prepare.locations(board(spark, rows).drop("locations"))
    assert sorted(ids(joins.drop_duplicates(found))) == ["0001", "0003"]


def test_view_filters_reach_the_scan(spark, tmp_path):
    """On the stored table type, flags, category and day are tested by the reader."""
    path = str(tmp_path / "stored")
    stored = prepare.with_defaults(spark.createDataFrame(random_board(5), schema.LISTING))
    stored.write.parquet(path)
    view = View(type="newgrad", days="7", noclear=True, q="soc")
    shown = filters.board_view(prepare.prepare(spark.read.parquet(path), AS_OF), view, AS_OF)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = shown.select("id", "company", "date_added", "closed")._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    for part in ("EqualTo(type,newgrad)", "Not(EqualTo(closed,true))", "Not(EqualTo(clearance,true))",
                 "GreaterThanOrEqual(date_added,2026-11-14)"):
        assert part in pushed, pushed
    assert "url" not in plan.split("ReadSchema:")[1]


def test_search_table_prunes_types_and_days(spark, tmp_path):
    path = str(tmp_path / "search")
    raw = prepare.with_defaults(spark.createDataFrame(random_board(6), schema.LISTING))
    publish.write_search_table(raw, path)
    table = publish.read_search_table(spark, path, AS_OF)
    view = View(type="newgrad", days="7", q="soc an")
    want = ids(filters.board_view(prepare.prepare(raw, AS_OF), view, AS_OF))
    shown = filters.board_view(table, view, AS_OF)
    assert want and ids(shown) == want
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = shown.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "(type#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(date_added,2026-11-14)" in plan
    assert "translate" not in plan


def test_signs_that_spell_several_letters(spark):
    from vacantia.functions.text import query_words, words

    texts = ["Ｃ＃ ㎏ ⑫ ⒜ ㏄ ﬁne ½", "Straße ĳ", "№ 5 ㎐ ™", "plain", "été ﷺ x"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: r["w"] for r in rows.select("t", words(F.col("t")).alias("w")).collect()}
    assert got == {t: query_words(t) for t in texts}
    assert got[texts[0]][1:5] == ["kg", "12", "a", "cc"]


def test_searches_are_filed_under_their_rarest_key(spark):
    searches = spark.createDataFrame(
        [(1, "intern", ["security", "xylophone"], [], ""), (2, "intern", ["security"], ["soc"], "TX"),
         (3, "intern", [], [], ""), (4, "intern", ["ab"], ["soc", "grc"], ""), (5, "intern", ["none"], [], "")],
        "search_id int, type string, needles array<string>, cat array<string>, state string",
    )
    counts = {"w:sec": 9, "w:xyl": 2, "c:soc": 3, "c:grc": 4, "s:TX": 5, "t:": 10}
    keys = spark.createDataFrame([("intern", k) for k, n in counts.items() for _ in range(n)], "type string, key string")
    got = sorted((r["search_id"], r["key"], r["n"]) for r in views.file_searches(views.search_options(searches), keys).collect())
    assert got == [(1, "w:xyl", 2), (2, "c:soc", 3), (3, "t:", 10), (4, "c:grc", 4), (4, "c:soc", 3), (5, "w:non", 0)]
