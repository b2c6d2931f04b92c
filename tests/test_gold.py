"""A published data set, if a folder with one is given, against its own printed figures.

``GOLD_DIR`` names a folder of markdown files: the tables, with a line of headline figures,
and the employer pages. Titles were partly judged from texts that are not in the tables, so
agreement of the rules is measured, not demanded in full.
"""

import os
import re

import pytest
from pyspark.sql import functions as F

from vacantia.functions.text import title_text
from vacantia.operators import counts, prepare, quality, repeats, sorts
from vacantia.rules import classify, level
from vacantia.sources import published

GOLD = os.environ.get("GOLD_DIR", "")
AS_OF = "2026-11-21"
pytestmark = pytest.mark.skipif(not os.path.isdir(GOLD), reason="GOLD_DIR is not set")


def _pages():
    for name in sorted(os.listdir(GOLD)):
        if name.endswith(".md"):
            with open(os.path.join(GOLD, name), encoding="utf-8") as file:
                yield os.path.join(GOLD, name), file.read()


@pytest.fixture(scope="module")
def tables(spark):
    path = next(p for p, text in _pages() if "<!-- TABLE_START" in text)
    rows = published.read_published(spark, path, AS_OF)
    return rows.withColumn("id", F.format_string("%06d", F.col("at"))).cache()


@pytest.fixture(scope="module")
def employer_page():
    return next(text for _, text in _pages() if "companies tracked" in text)


@pytest.fixture(scope="module")
def board(tables):
    plain = tables.withColumns(
        {"states": F.array().cast("array<string>"), "remote": F.lit(False),
         "category": F.coalesce("category", F.lit(""))}
    )
    return prepare.prepare(plain, AS_OF).cache()


def test_headline(tables, board):
    text = next(t for _, t in _pages() if "<!-- STATS -->" in t)
    stats = text.split("<!-- STATS -->")[1].split("<!-- /STATS -->")[0]
    want = [int(n) for n in re.findall(r"\*\*(\d+)\*\*", stats)]
    got = counts.headline(board, AS_OF).first()
    assert [got["intern"], got["newgrad"], got["earlycareer"], got["new_rows"], got["clearance_rows"]] == want


def test_closed_counts(board):
    text = next(t for _, t in _pages() if "<!-- CLOSED_START" in t)
    want = [int(n) for n in re.findall(r"(\d+) closed in the last 60 days", text)]
    got = {r["type"]: r["n"] for r in counts.closed_counts(board, AS_OF).collect()}
    assert [got["intern"], got["newgrad"], got["earlycareer"]] == want


def test_new_marks(board):
    wrong = board.where(~F.col("closed") & (prepare.is_new() != F.col("marked_new")))
    assert wrong.count() == 0


def test_orders_and_repeat_marks(board, tables):
    open_rows = tables.where("NOT closed")
    for order, rows in ((sorts.published_open, open_rows), (sorts.published_closed, tables.where("closed"))):
        printed = rows.orderBy("type", "at").select("type", "company").collect()
        sorted_rows = order(rows).select("type", "company").collect()
        assert [tuple(r) for r in sorted_rows] == [tuple(r) for r in printed]
    marks = repeats.published(open_rows.withColumnRenamed("is_repeat", "printed"))
    assert marks.where("is_repeat <> printed").count() == 0
    assert quality.reconcile(tables, tables).collect() == []


def test_hiring_pivot(board, employer_page):
    lines = re.findall(r"^\| ([^|]+) \| (\d*) *\| (\d*) *\| (\d*) *\|$", employer_page, re.M)
    want = [(c, *(int(n) if n else None for n in ns)) for c, *ns in lines]
    got = [tuple(r) for r in sorts.hiring_order(counts.hiring_pivot(board)).collect()]
    assert len(want) == int(re.search(r"Hiring students now \((\d+)\)", employer_page).group(1))
    assert got == want


def test_employers_per_platform(spark, employer_page):
    rows, platform = [], None
    for line in employer_page.split("## Every tracked board")[1].splitlines():
        head = re.match(r"### (.+) \((\d+)\)", line)
        if head:
            platform = head.group(1)
        elif line.startswith("- "):
            rows.append((platform, line[2:].replace("🛡️", "").strip(), "🛡️" in line))
    frame = spark.createDataFrame(rows, "platform string, name string, security_company boolean")
    got = {r["platform"]: r["employers"] for r in counts.boards_per_platform(frame).collect()}
    want = {p: int(n) for p, n in re.findall(r"^### (.+) \((\d+)\)$", employer_page, re.M)}
    total = int(re.search(r"\*\*(\d+) companies tracked", employer_page).group(1))
    assert got == {**want, None: total}
    directory = [(r["platform"], r["name"]) for r in sorts.employer_directory(frame).collect()]
    assert directory == [(p, n) for p, n, _ in rows]


def test_rule_agreement(spark, tables, employer_page):
    secure = [m.strip() for m in re.findall(r"^- (.+?)🛡️", employer_page, re.M)]
    rows = tables.select(
        "closed", F.col("type").alias("want_type"), F.col("category").alias("want_category"),
        F.col("role").alias("title"), F.lit("").alias("description"), "location",
        F.col("company").isin(secure).alias("sec_co"),
    )
    judged = classify.classify(rows.where("NOT closed"), AS_OF)
    same = judged.select(
        F.col("category").eqNullSafe(F.col("want_category")).cast("int").alias("same")
    ).agg(F.avg("same"))
    assert same.first()[0] >= 0.98
    titled = rows.withColumn("t", level.level_from_title(title_text(F.col("title")), AS_OF)).where("t IS NOT NULL")
    agree = titled.agg(F.avg((F.col("t") == F.col("want_type")).cast("int"))).first()[0]
    assert agree >= 0.99
    missed = judged.where("reason NOT IN ('level')").count()
    assert missed <= 2
