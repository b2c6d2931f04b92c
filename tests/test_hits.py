"""Rule hits against a plain count, and the union of differently shaped dumps."""

import random

from pyspark.sql import functions as F

from vacantia.functions.text import query_words
from vacantia.rules.hits import rule_hits
from vacantia.session import fixed_table
from vacantia.sources.postings import union_postings


def test_hits_equal_a_plain_count(spark):
    pick = random.Random(7)
    vocabulary = ["soc", "cloud", "sec", "Ö", "a", "b"]
    docs = [(i, ", ".join(pick.choices(vocabulary, k=pick.randrange(60)))) for i in range(40)]
    rules = [
        ("one", "SOC"), ("two", "cloud sec"), ("same", "a a"), ("three", "a b a"), ("accent", "o"),
        ("none", "zebra"), ("empty", " - "),
    ]
    got = rule_hits(
        spark.createDataFrame(docs, "doc_id int, text string"),
        spark.createDataFrame(rules, "rule string, phrase string"),
    )
    want = {}
    for doc, text in docs:
        words = query_words(text)
        for rule, phrase in rules:
            parts = query_words(phrase)
            n = sum(words[i : i + len(parts)] == parts for i in range(len(words)) if parts)
            if n:
                want[doc, rule] = n
    assert {(r["doc_id"], r["rule"]): r["n"] for r in got.collect()} == want


def test_union_of_dumps(spark):
    lever = spark.createDataFrame([("1", "Intern", "Remote")], "id string, text string, place string")
    jibe = spark.createDataFrame([((2, "Analyst"),)], "job struct<id: int, title: string>")
    got = union_postings(
        {
            "lever": (lever, {"posting_id": "id", "title": "text", "location": "place"}),
            "jibe": (jibe, {"posting_id": "CAST(job.id AS STRING)", "title": "job.title"}),
        }
    )
    rows = got.select("platform", "posting_id", "title", "location").orderBy(F.col("posting_id"))
    assert [tuple(r) for r in rows.collect()] == [
        ("lever", "1", "Intern", "Remote"), ("jibe", "2", "Analyst", None),
    ]


def test_small_rules_go_to_the_texts(spark, tmp_path):
    """The rules are sent to the texts, not the words of the texts to the rules."""
    path = str(tmp_path / "docs")
    spark.range(50).select(F.col("id").alias("doc_id"), F.lit("soc cloud").alias("text")).write.parquet(path)
    rules = fixed_table(spark, [("it's", "soc"), ("b\\s", "soc cloud")], "rule, phrase")
    got = rule_hits(spark.read.parquet(path), rules)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BuildRight" in plan and "BuildLeft" not in plan and "SortMergeJoin" not in plan
    assert {(r["rule"], r["n"]) for r in got.collect()} == {("it's", 1), ("b\\s", 1)}
