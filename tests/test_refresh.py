"""A scan from postings to the stored table."""

import datetime

from pyspark.sql import functions as F

from vacantia.operators import refresh

AS_OF = "2026-11-21"
DAY = datetime.date(2026, 11, 1)


def day(n):
    return DAY + datetime.timedelta(n)


def test_amazon_and_repeated_postings(spark):
    rows = [
        ("lever", "b", "1", "Security Analyst I", "https://jobs.lever.example/1"),
        ("lever", "b", "1", "Security Analyst I", "https://jobs.lever.example/1"),
        ("lever", "unknown", "2", "Security Analyst I", "https://jobs.lever.example/2"),
        ("amazon", None, "3", "Cloud Security Engineer I", "https://amazon.example/3"),
        ("amazon", None, "4", "Cook", "https://amazon.example/4"),
    ]
    postings = spark.createDataFrame(
        rows, "platform string, board_key string, posting_id string, title string, url string"
    ).withColumns({"location": F.lit("Austin, TX"), "description": F.lit("1 year of experience.")})
    employers = spark.createDataFrame(
        [("lever", "b", "Board Co", False, [], [])],
        "platform string, board_key string, name string, security_company boolean, "
        "search_terms array<string>, apply_hosts array<string>",
    )
    vendors = spark.createDataFrame(
        [("lever", "lever.example", "https://lever.example")], "platform string, domain string, job_page string"
    )
    got = refresh.board_rows(postings, employers, vendors, AS_OF).collect()
    assert sorted((r["id"], r["company"], r["source"], r["url"]) for r in got) == [
        ("amazon/3", "Amazon", "board", "https://amazon.example/3"),
        ("lever/b/1", "Board Co", "board", "https://jobs.lever.example/1"),
    ]


def test_one_scan_after_another(spark):
    """New, kept, closed, reopened, untracked and expired rows; a second run changes nothing. A row that was untracked and
    is read again is back; one whose term is over is not."""
    schema = "id string, closed boolean, closed_date date, reason string, reopened_date date"
    stored = spark.createDataFrame(
        [("kept", False, None, None, None), ("gone", False, None, None, None),
         ("back", True, day(0), "absent", None), ("out", True, day(0), "untracked", None),
         ("term", True, day(0), "expired", None),
         ("old", True, day(-90), "absent", None), ("link", False, None, None, None)], schema,
    )
    found = spark.createDataFrame([("kept", False), ("new", False), ("back", False), ("out", False), ("term", False)], "id string, closed boolean")
    seen = spark.createDataFrame(
        [("kept", day(9)), ("new", day(9)), ("back", day(5)), ("back", day(9)), ("out", day(9)), ("term", day(9)), ("gone", day(2)),
         ("link", day(8))], "listing_id string, day date",
    )
    closings = lambda rows: spark.createDataFrame(rows, "listing_id string, closed_date date")
    closers = {"absent": closings([("gone", day(5))]), "link gone": closings([("link", day(7)), ("kept", day(9))])}

    def run(table):
        rows = refresh.update_table(table, found, seen, closers, day(10).isoformat())
        return rows, {r["id"]: (r["closed_date"], r["reason"], r["reopened_date"]) for r in rows.collect()}

    rows, once = run(stored)
    assert once == {
        "kept": (day(9), "link gone", None), "new": (None, None, None), "gone": (day(5), "absent", None),
        "back": (None, None, day(5)), "out": (None, None, day(9)), "term": (day(0), "expired", None), "link": (None, None, None),
    }
    assert run(rows)[1] == once
