"""Repeated passages against all windows of all documents."""

import hashlib
import random
from collections import Counter

import pytest

from vacantia.llm import queries, suffixes


def brute(rows, length):
    """(id, n_bytes, n_removed, n_spans, sha256) of each row."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(t[k : k + length] for _, t in texts for k in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = b"\1" * length
        spans = sum(g and not p for g, p in zip(gone, b"\0" + gone))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(frame):
    return sorted(
        (
            (r["id"], r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), r["kept_sha256"])
            for r in frame.collect()
        ),
        key=repr,
    )


def test_covers_bring_any_two_places_together():
    for v, cover in suffixes.COVERS.items():
        assert {(a - b) % v for a in cover for b in cover} == set(range(v))


@pytest.mark.parametrize("length", [1, 4, 9, 20, 33, 60])
def test_random_texts(spark, make, length, monkeypatch):
    monkeypatch.setattr(suffixes, "BLOCK", 700)
    monkeypatch.setattr(suffixes, "BUCKET", 512)
    rng = random.Random(length)
    pool = ["".join(rng.choice("ab") for _ in range(rng.randrange(3 * length + 5))) for _ in range(6)]
    rows = []
    for i in range(40):
        text = ""
        for _ in range(rng.randrange(5)):
            piece = rng.choice(pool)
            a = rng.randrange(len(piece) + 1)
            text += piece[a : a + rng.randrange(2 * length + 3)] + rng.choice(["", "é", "x%d" % rng.randrange(9)])
        rows.append((i, text))
    assert result(suffixes.repeats(make(rows), length=length)) == brute(rows, length)


def test_query_equals_brute_force(spark, folder, documents):
    got = sorted(
        ((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
         for r in queries.QUERIES["op8_suffix_dedup"](spark, folder).collect()),
        key=repr,
    )
    assert got == brute([(i, t) for i, t, _ in documents], 200)


def test_edges_of_shared_passages(spark, make):
    rng = random.Random(7)
    word = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    passage = word(450)
    rows = [(i, word(rng.randrange(50)) + passage[rng.randrange(60) : 450 - rng.randrange(60)] + word(40)) for i in range(40)]
    rows += [(100, passage), (101, passage[:199]), (102, passage[:200]), (103, passage[100:301]), (104, word(300))]
    rows += [(200 + i, passage[i * 9 : i * 9 + 210]) for i in range(20)]
    assert result(suffixes.repeats(make(rows))) == brute(rows, 200)


def test_odd_rows(spark, make):
    rows = [(1, None), (2, ""), (None, "a" * 500), (3, " " * 100_000), (4, "z" * 199), (5, "é" * 300), (6, "u" * 250)[:2]]
    rows += [(7, "same text " * 30)] * 3
    rows += [(8, "".join(map(str, range(2000))))] * 2
    frame = make(rows, extra=("block", "id", "data", "spans"))
    want = brute([r for r in rows if r[0] != 3], 200)
    got = result(suffixes.repeats(frame))
    assert [g for g in got if g[0] != 3] == want
    assert next(g for g in got if g[0] == 3)[2:4] == (100_000, 1)
    assert suffixes.repeats(make([])).collect() == []
