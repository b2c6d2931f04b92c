"""Licence scans by a positional index of rare words; DataFrame functions only.

Each template is indexed by the positions of its highest-IDF words, where IDF is counted over all files
scanned. All indexed words of a file are looked up, their postings are joined and grouped by relative
position (place in the file less place in the template), and the best aligned share of a
template's weight is its score. A template is reported if its score reaches the threshold and every
mandatory phrase of it stands in the file.

Base phrases are counted beside it, as word sequences wherever they stand.

Defined results: a null text has no words; repeated rows get equal rows; other columns are never read.
"""

from __future__ import annotations

import functools
import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.llm.common import row_key, settle
from vacantia.session import fixed_table

# The base phrases and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Label, mandatory phrases (all must stand in the file), wording that is indexed.
TEMPLATES = (
    ("gpl", ("gnu general public license",), "gnu general public license"),
    ("apache", ("apache license",), "apache license"),
    ("mit", ("mit license",), "mit license"),
    ("cc-by", ("cc by",), "licensed under cc by"),
    ("gpl-3.0", ("gnu general public license", "version 3"), "licensed under the gnu general public license version 3"),
    ("gpl-2.0", ("gnu general public license", "version 2"), "licensed under the gnu general public license version 2"),
    ("lgpl", ("gnu lesser general public license",), "under the terms of the gnu lesser general public license"),
    ("agpl-3.0", ("gnu affero general public license",), "under the terms of the gnu affero general public license version 3"),
    ("apache-2.0", ("apache license", "version 2 0"), "licensed under the apache license version 2 0"),
    ("cc-by-4.0", ("cc by 4 0",), "licensed under cc by 4 0"),
    ("cc-by-sa-4.0", ("cc by sa 4 0",), "licensed under cc by sa 4 0"),
    ("cc-by-nc-4.0", ("cc by nc 4 0",), "licensed under cc by nc 4 0"),
    ("cc-by-nd-4.0", ("cc by nd 4 0",), "licensed under cc by nd 4 0"),
    ("cc0-1.0", ("cc0 1 0",), "cc0 1 0 universal public domain dedication"),
    ("mit", ("permission is hereby granted", "the software is provided as is"),
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files to deal in the software without restriction"),
    ("isc", ("permission to use copy modify and or distribute this software",),
     "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", ("redistribution and use in source and binary forms",),
     "redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met"),
    ("mpl-2.0", ("mozilla public license", "2 0"), "subject to the terms of the mozilla public license v 2 0"),
    ("epl-2.0", ("eclipse public license", "2 0"), "made available under the terms of the eclipse public license 2 0"),
    ("unlicense", ("released into the public domain",),
     "this is free and unencumbered software released into the public domain"),
    ("all-rights-reserved", ("all rights reserved",), "all rights reserved"),
)

#: Rarest words of a template that are indexed.
TEMPLATE_WORDS = 8
#: Least aligned share of a template's weight.
MIN_SCORE = 0.6

_SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_LETTER = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def _phrase(phrase: str) -> str:
    body = f"{_SEPARATOR}+".join(phrase.split())
    return f"(?i)(?<!{_LETTER}){body}(?!{_LETTER})"


def _stands(text: Column, phrase: str) -> Column:
    return text.rlike(_phrase(phrase))


def _vocabulary() -> list[str]:
    return sorted({w for _, phrases, body in TEMPLATES for t in (*phrases, body) for w in t.split()})


def _anchors() -> list[str]:
    """One word of each first mandatory phrase: a file without any of them can hold no licence."""
    return sorted({max(phrases[0].split(), key=len) for _, phrases, _ in TEMPLATES})


def words(text: Column) -> Column:
    """The words of a text, A-Z in lower case.

    Lower case of other letters stays outside ASCII, but for two of which the lower case holds an ASCII
    letter; these are put aside first.
    """
    plain = F.lower(F.regexp_replace(text, "[İK]", "ÿ"))
    return F.filter(F.split(plain, f"{_SEPARATOR}+"), lambda w: w != "")


def _count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"{_LETTER}+"))


def scan_files(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One pass over the texts: words, base phrases, licence words, and the text of possible holders."""
    vocabulary = F.array(*map(F.lit, _vocabulary()))
    anchors = F.array(*map(F.lit, _anchors()))
    rows = documents.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = rows.select(
        row_key("id", "text").alias("key"), "id", "text", words(F.col("text")).alias("words"),
    ).select(
        "key", "id", F.size("words").cast("long").alias("n_words"),
        F.array_intersect("words", vocabulary).alias("licence_words"), "text",
    ).withColumn("text", F.when(F.arrays_overlap("licence_words", anchors), F.col("text")))
    columns = ["key", "id", "n_words", "licence_words", "text"]
    for i, (phrase, _) in enumerate(BASE):
        parts = F.split("text", _phrase(phrase), -1)
        found = found.withColumn(f"parts{i}", F.when(_stands(F.col("text"), phrase), parts))
        has, size = F.col(f"parts{i}").isNotNull(), len(phrase.split())
        columns += [
            F.when(has, F.size(f"parts{i}") - 1).otherwise(0).cast("long").alias(f"n{i}"),
            F.when(has, _count(F.element_at(f"parts{i}", 1))).cast("long").alias(f"first{i}"),
            F.when(has, F.col("n_words") - size - _count(F.element_at(f"parts{i}", -1))).alias(f"last{i}"),
        ]
    return settle(found.select(*columns), "licences")


def template_index(files: DataFrame) -> DataFrame:
    """(label, template, word, at, idf, weight): postings of each template's rarest words.

    IDF counts the files of the whole table that hold a word; the table of it has one row for each word of
    the templates, whatever the number of files.
    """
    spark = files.sparkSession
    total = files.count()
    counts = files.select(F.explode("licence_words").alias("word")).groupBy("word").count()
    files_with = {r["word"]: r["count"] for r in counts.collect()}
    idf = {w: math.log((total + 1) / (files_with.get(w, 0) + 0.5)) + 1e-6 for w in _vocabulary()}
    rows = []
    for i, (label, _, body) in enumerate(TEMPLATES):
        body = body.split()
        rare = sorted(set(body), key=lambda w: (-idf[w], w))[:TEMPLATE_WORDS]
        postings = [(at, w) for at, w in enumerate(body) if w in rare]
        weight = sum(idf[w] for _, w in postings)
        rows += [(label, i, w, at, idf[w], weight) for at, w in postings]
    return fixed_table(spark, rows, "label, template, word, at, idf, weight")


def align(files: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """(key, score, labels) of the files that hold a template."""
    index = template_index(files)
    holders = files.where("text IS NOT NULL").select("key", "text").dropDuplicates(["key"])
    places = holders.select("key", F.posexplode(words(F.col("text"))).alias("place", "word"))
    aligned = (
        places.join(index, "word")
        .groupBy("key", "template", "label", (F.col("place") - F.col("at")).alias("shift"))
        .agg(F.sum("idf").alias("sum"), F.first("weight").alias("weight"))
        .groupBy("key", "template", "label").agg(F.max(F.col("sum") / F.col("weight")).alias("score"))
        .where(F.col("score") >= min_score)
    )
    text = F.col("text")
    verified = F.array_compact(F.array(*[
        F.when(functools.reduce(Column.__and__, [_stands(text, p) for p in phrases]), F.lit(i))
        for i, (_, phrases, _) in enumerate(TEMPLATES)
    ]))
    return (
        holders.select("key", F.explode(verified).alias("template")).join(aligned, ["key", "template"])
        .groupBy("key").agg(F.least(F.max("score"), F.lit(1.0)).alias("score"), F.collect_set("label").alias("found"))
    )


def scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits) -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    files = scan_files(documents, id_col, text_col)
    range_ = range(len(BASE))
    base = F.array_compact(F.array(*[F.when(F.col(f"n{i}") > 0, F.lit(BASE[i][1])) for i in range_]))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return files.join(align(files, **limits), "key", "left").select(
        "id", "n_words",
        functools.reduce(Column.__add__, [F.col(f"n{i}") for i in range_]).alias("n_base"),
        F.least(*[F.col(f"first{i}") for i in range_]).alias("first_word"),
        F.greatest(*[F.col(f"last{i}") for i in range_]).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.concat(base, F.coalesce("found", F.array().cast("array<string>")))).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def plain_words(text: str) -> list[str]:
    """The words of a text, for tests."""
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
