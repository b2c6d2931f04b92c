"""Rules held in a table: which entry of any lexicon hits which document, how often."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacantia.functions.text import words


def rule_hits(docs: DataFrame, rules: DataFrame) -> DataFrame:
    """Count of each rule's phrase per document, over the whole text.

    ``docs`` holds (doc_id, text), ``rules`` (rule, phrase). Words and positions of the
    texts meet the words of the phrases by equality. Each meeting points to where its
    phrase would start; a start that all the words of the phrase point to is a hit. The
    words of one document are counted in the task that split it, before any shuffle.
    """
    phrases = rules.select("rule", words(F.col("phrase")).alias("ws")).where("size(ws) > 0")
    wanted = phrases.select("rule", F.size("ws").alias("len"), F.posexplode("ws").alias("k", "word"))
    tokens = docs.select("doc_id", F.posexplode(words(F.col("text"))).alias("at", "word"))
    met = tokens.join(wanted, "word").select(
        "doc_id", "rule", "len",
        # A phrase of one word needs no start: its meetings are its hits.
        F.when(F.col("len") > 1, F.col("at") - F.col("k")).otherwise(F.lit(0)).alias("start"),
    )
    starts = met.groupBy("doc_id", "rule", "len", "start").agg(F.count(F.lit(1)).alias("found"))
    hits = F.when(F.col("len") == 1, F.col("found")).when(
        F.col("found") == F.col("len"), F.lit(1).cast("long")
    )
    counted = starts.groupBy("doc_id", "rule").agg(F.sum(hits).alias("n"))
    return counted.where("n > 0")
