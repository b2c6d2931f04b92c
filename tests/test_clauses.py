"""Years by clause, pay rates, places abroad, terms with signs, pipes in published text, printed order."""

import datetime

import pytest
from pyspark.sql import functions as F

from vacantia.functions.text import title_text
from vacantia.operators import prepare, publish, quality, views
from vacantia.rules import experience, rejects, usplaces
from vacantia.sources import postings, published

AS_OF = "2026-11-21"

FLOORS = [
    ("Requires 5 years of experience, MBA preferred.", 5),
    ("At least 21 years old and 6 years of security experience.", 6),
    ("Must be at least 18 years of age.", None),
    ("6 years preferred.", None),
    ("Five years of experience required.", 5),
    ("Five (5) years in a SOC.", 5),
    ("Two to four years of networking.", 2),
    ("Preferred qualifications: 5 years of Python, 3 years of Go.", None),
    ("Ideally, 4 years of Java.", None),
    ("2+ years of Python, 5 years of Go preferred.", 2),
    ("5 years of Python, Java, or Go preferred.", None),
    ("BS and 4 years, or MS and 2, or PhD and 0.", 0),
    ("Our 30+ years of experience help you; 3 years required.", 3),
    ("Join our 30 years of experience and bring 4 years of yours.", 4),
    ("Bachelor's and 3 years, or 7 years in lieu of a degree.", 3),
    ("A bachelor's in one of many fields and 1 year of practice.", 1),
    ("No experience required; 3 years a bonus.", 0),
    ("Send us a letter.", None),
    ("Over the past 25 years our company grew. 1 year of experience.", 1),
    ("For 40 years, we have made locks. 2 years of scripting.", 2),
    ("Our firm has built locks for 30 years, and asks for 4 years.", 4),
    ("We require 5 years of experience.", 5),
    ("Candidates with over 5 years of experience.", 5),
    ("5+ years of experience with our tools.", 5),
    ("3 years of hunting within the last 5 years.", 3),
    ("A minimum of 60 months of experience.", 5),
    ("18 months' experience in a SOC.", 1),
    ("24 to 36 months of hands-on security experience.", 2),
    ("Twelve months of experience.", 1),
    ("A 12 month program; you start within 6 months.", None),
    ("BS and 48 months of experience, or MS and 24 months of experience.", 2),
]


@pytest.fixture(scope="module")
def floors(spark):
    rows = spark.createDataFrame([(i, s) for i, (s, _) in enumerate(FLOORS)], "i int, s string")
    return dict(rows.select("i", experience.years_floor(F.col("s"))).collect())


@pytest.mark.parametrize("i", range(len(FLOORS)), ids=[s for s, _ in FLOORS])
def test_years_by_clause(floors, i):
    assert floors[i] == FLOORS[i][1]


def test_pay_rates(spark):
    titles = {
        "SOC Analyst I - 24 hr Operations": None, "Security Analyst - $18.50/hr": "plant security",
        "Security Analyst 18/hr": "plant security", "Security Analyst $20 an hour": "plant security",
        "Security Analyst USD 25 per hour": "plant security",
    }
    rows = spark.createDataFrame([(t,) for t in titles], "title string")
    got = rows.select("title", rejects.reject_reason(title_text(F.col("title")), title=F.col("title"))).collect()
    assert {r[0]: r[1] for r in got} == titles


def test_places_abroad(spark):
    titles = {
        "Cybersecurity Analyst I - Costa Rica": True, "Cybersecurity Analyst I - Sweden": True,
        "Security Engineer I - Mexico": True, "Security Engineer Mexico": True, "Security Engineer I - New Mexico": False,
        "Security Engineer I - Georgia": False, "Security Engineer I": False,
        "Engineer located at Ramstein AFB, Germany": True,
        "Cybersecurity Analyst I - London": True, "SOC Analyst I - Bengaluru": True,
        "Security Analyst Intern, Toronto": True, "Cyber Security Intern (Mexico City)": True,
        "Security Analyst I - New England": False, "Security Analyst I - London, KY": False,
        "Security Analyst I, New London": False, "Security Analyst I - New Delhi": True,
        "Security Analyst I (São Paulo, Hybrid)": True, "Security Analyst I - Tel Aviv Office": True,
        "Security Analyst I (Remote)": False, "Remote": False, "London": True, "": False,
    }
    rows = spark.createDataFrame([(t,) for t in titles], "title string")
    got = rows.select("title", usplaces.placed_abroad(title_text(F.col("title")))).collect()
    assert {r[0]: r[1] for r in got} == titles


def test_a_town_at_home_with_the_name_of_a_city_abroad(spark):
    rows = [
        ("Security Analyst I - Vienna", "Vienna, VA", "Vienna, VA"), ("Security Analyst I - Vienna", "Austin, TX", ""),
        ("Security Analyst I - Dublin", "Remote (US); Dublin, OH", "Remote (US);Dublin, OH"),
        ("Security Analyst I - Vienna", "Vienna, Virginia", ""), ("Security Analyst I - Pune", "Austin, TX", ""),
        ("Security Analyst I", None, ""),
    ]
    frame = spark.createDataFrame(rows, "title string, location string, want string")
    kept = usplaces.drop_foreign(F.col("location"), title_text(F.col("title")))
    for r in frame.select("title", "location", "want", F.array_join(kept, ";").alias("got")).collect():
        assert r["got"] == r["want"], r


def test_terms_are_read_as_words(spark):
    rows = spark.createDataFrame(
        [("workday", "third party risk analyst", ["third-party risk"]), ("workday", "cafe cook", ["Café"]),
         ("workday", "cook", ["", "-"]), ("workday", "cyber cook", None), ("lever", "cook", None)],
        "platform string, hay string, search_terms array<string>",
    )
    kept = rows.where(postings.found_by_terms(F.concat(F.lit(" "), "hay"), ("cyber",)))
    searched = [r["hay"] for r in kept.where("platform = 'workday'").collect()]
    assert sorted(searched) == ["cafe cook", "cyber cook", "third party risk analyst"]
    assert kept.where("platform = 'lever'").count() == 1


def board(spark, rows):
    day = datetime.date(2026, 11, 1)
    schema = (
        "id string, type string, company string, role string, category string, location string, "
        "locations array<string>, states array<string>, remote boolean, clearance boolean, url string, "
        "date_added date, closed boolean, closed_date date, source string, reopened_date date"
    )
    made = [
        (str(i), "intern", company, role, "GRC & Risk", spot, [spot], ["VA"], False, False,
         f"https://j.example/{i}", day - datetime.timedelta(i), shut, day if shut else None, "board", None)
        for i, (company, role, spot, shut) in enumerate(rows)
    ]
    listings = prepare.prepare(spark.createDataFrame(made, schema), AS_OF)
    return listings.withColumn("is_new", prepare.is_new())


def test_pipes_and_company_names_come_back(spark, tmp_path):
    rows = board(spark, [
        ("A | B", "SOC | Analyst", "Reston | East, VA", False), ("Company Nurse", "2027 | Americas", "Austin, TX", False),
        ("C|D|", "|edge|", "Austin, TX", True), ("Back\\|slash", "a \\| b", "Austin, TX", False),
    ])
    path = str(tmp_path / "tables")
    publish.write_published(rows, path)
    back = published.read_published(spark, path, AS_OF).cache()
    got = {(r["company"], r["role"]) for r in back.collect()}
    assert got == {("A | B", "SOC | Analyst"), ("Company Nurse", "2027 | Americas"), ("C|D|", "|edge|"),
                   ("Back\\|slash", "a \\| b")}
    assert back.where("company = 'A | B'").first()["locations"] == ["Reston | East, VA"]
    assert quality.reconcile(back, rows).collect() == []
    assert {r["n"] for r in quality.out_of_order(back).collect()} == {0}


def test_rows_out_of_order_are_counted(spark):
    day = datetime.date(2026, 1, 1)
    rows = [("x", s, i, day + datetime.timedelta(d), c) for s, i, d, c in
            [(0, 1, 9, "A"), (0, 2, 8, "A"), (0, 3, 9, "A"), (5, 4, 10, "A"), (5, 5, 1, "A"),
             (5, 6, 0, "B Co"), (5, 7, 0, "a co"), (5, 8, 0, "A Co"), (9, 9, 0, "Á Ab"), (9, 10, 0, "b")]]
    made = spark.createDataFrame(rows, "file string, split int, at int, date_added date, company string")
    for shut in ("false", "true"):
        table = made.selectExpr("'intern' AS type", f"{shut} AS closed", "'f' AS folder", "*", "date_added AS closed_date")
        assert [tuple(r) for r in quality.out_of_order(table).collect()] == [("intern", shut == "true", 5)]


def test_every_view_has_its_search(spark):
    shared = spark.createDataFrame(
        [(1, "intern", "cloud sec", ["a", "b"]), (2, "intern", "sec  Cloud", ["b", "a"]), (3, "intern", "soc", [])],
        "view_id long, type string, q string, cat array<string>",
    ).selectExpr("*", "'' AS state", "'' AS days", "false AS noclear", "false AS closed")
    got = sorted(tuple(r) for r in views.view_searches(shared).collect())
    assert got == [(1, 1), (2, 1), (3, 3)]
