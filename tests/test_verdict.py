"""Stored closings, cancelled closings, missing grace, stray percent signs and wide letters."""

from pyspark.sql import functions as F

from vacantia.functions import text, urls
from vacantia.operators import lifecycle


def test_wide_and_styled_letters_fold(spark):
    rows = [("Ｓｅｃｕｒｉｔｙ",), ("ⓢⓞⓒ",), ("𝐜𝐥𝐨𝐮𝐝",), ("café",)]
    got = spark.createDataFrame(rows, "t string").select(text.fold(F.col("t"))).collect()
    assert [r[0] for r in got] == ["security", "soc", "cloud", "cafe"]


def test_stray_percent_signs_are_kept(spark):
    rows = [("https://a.b/?q=100%",), ("https://a.b/?q=%zz+soc",), ("https://a.b/?q=a%20b",), ("https://a.b/",)]
    got = spark.createDataFrame(rows, "u string").select(urls.query_param(F.col("u"), "q")).collect()
    assert [r[0] for r in got] == ["100%", "%zz soc", "a b", ""]


def test_a_good_check_cancels_a_closing(spark):
    rows = [("a", f"2024-01-0{i + 1}", o) for i, o in enumerate(["gone", "gone", "ok", "ok"])]
    rows += [("b", f"2024-01-0{i + 1}", o) for i, o in enumerate(["gone", "ok", "gone", "gone"])]
    probes = spark.createDataFrame(rows, "listing_id string, d string, outcome string").select(
        "listing_id", F.to_date("d").alias("probe_date"), "outcome"
    )
    got = [(r[0], str(r[1])) for r in lifecycle.close_dead_links(probes).collect()]
    assert got == [("b", "2024-01-04")]


def test_resolving_twice_changes_nothing(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "listing_id string")
    gone = spark.createDataFrame([("a", "2024-01-05")], "listing_id string, d string").select(
        "listing_id", F.to_date("d").alias("closed_date")
    )
    once = lifecycle.resolve_lifecycle(rows, {"untracked": gone})
    again = lifecycle.resolve_lifecycle(once, {"untracked": gone.limit(0)})
    assert sorted(once.collect()) == sorted(again.collect())
    assert {r["listing_id"]: r["reason"] for r in again.collect()} == {"a": "untracked", "b": None}


def test_a_board_without_grace_has_the_usual_one(spark):
    seen = spark.createDataFrame([("a", "x", "2024-01-01")], "listing_id string, board string, d string").select(
        "listing_id", "board", F.to_date("d").alias("day")
    )
    none = spark.createDataFrame([], "board string, grace int")
    got = lifecycle.close_absent(lifecycle.gaps(seen, None, "2024-02-01", none)).collect()
    assert [(r[0], str(r[1])) for r in got] == [("a", "2024-01-04")]
