"""Licence scans against a brute-force phrase count, and the alignment on planted texts."""

import re

from vacantia.llm import licenses, queries


def brute(text):
    words = licenses.plain_words(text or "")
    found = [
        (i, label, len(phrase.split()))
        for phrase, label in licenses.BASE
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [f[0] for f in found]
    labels = ",".join(sorted({f[1] for f in found}))
    return len(words), len(found), min(starts, default=None), max(starts, default=None), labels


def test_query_equals_brute_force(spark, folder, documents):
    rows = {r["doc_id"]: r for r in queries.QUERIES["op3_license_scan"](spark, folder).collect()}
    assert len(rows) == len(documents)
    for doc_id, text, _ in documents:
        r = rows[doc_id]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(text)
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1


ROWS = [
    (1, "Head.\nThis work is licensed under the GNU  General\nPublic-License, version 3. MIT LICENSE mit license"),
    (2, "Licensed under CC BY-NC 4.0."),
    (3, None), (4, ""), (5, "ünder éApache License ccby cc_by"),
    (6, "xcc by, cc byé CC by"), (7, "All rights reserved. " * 3000), (8, "no licence and no rights"),
    (9, "Knu general public license, Gnu General Public License"),
    (10, "permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
         "associated documentation files, to deal in the software without restriction. THE SOFTWARE IS PROVIDED AS IS"),
    (10, "permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
         "associated documentation files, to deal in the software without restriction. THE SOFTWARE IS PROVIDED AS IS"),
    (11, "permission is hereby granted to nobody"),
]


def test_odd_rows_and_labels(spark, make):
    out = licenses.scan(make(ROWS, extra=("labels", "score", "key", "word"))).collect()
    assert len(out) == len(ROWS)
    got = {r["id"]: r for r in out}
    for doc_id, text in ROWS:
        r = got[doc_id]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == brute(text), text
    assert got[1]["labels"] == "gpl,gpl-3.0,mit" and got[1]["score"] == 1
    assert got[2]["labels"] == "cc-by,cc-by-nc-4.0"
    assert got[7]["labels"] == "all-rights-reserved"
    assert got[10]["labels"] == "mit"
    assert got[8]["labels"] == got[11]["labels"] == got[3]["labels"] == ""


def test_empty_table(spark, make):
    assert licenses.scan(make([])).collect() == []


def test_main_path_is_native(spark, folder):
    plan = queries.QUERIES["op3_license_scan"](spark, folder)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_a_file_of_all_templates_with_words_of_different_idf(spark, make):
    notices = "\n".join(f"{body}. {'. '.join(phrases)}" for _, phrases, body in licenses.TEMPLATES)
    common = "the license version 2 0 gnu general public apache licensed under".split()
    vocabulary = [w for w in licenses._vocabulary() if w not in common] + common
    rows = [(0, notices)] + [(1 + i, " x ".join(vocabulary[i:])) for i in range(len(vocabulary))]
    got = {r["id"]: r for r in licenses.scan(make(rows)).collect()}
    assert got[0]["labels"] == ",".join(sorted({label for label, _, _ in licenses.TEMPLATES}))
    assert got[0]["score"] == 1
