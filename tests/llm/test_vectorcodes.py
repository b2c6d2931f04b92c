"""Vector codes against plain arithmetic on whole numbers."""

import hashlib
import math
import random
from collections import defaultdict

import pytest

from vacantia.llm import vectorcodes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string, c0 string"


@pytest.fixture
def frame(spark):
    return lambda rows: spark.createDataFrame([(*r, "x", None, "y") for r in rows], SCHEMA)


def plain(rows, parts=16, entries=64, rounds=2):
    """{id: [(code, error)]} and the codebooks' digest."""
    kept = [(i, v, l) for i, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole = sorted(
        ((i is None, i or 0, [math.floor(256 * x) for x in v], v) for i, v, _ in kept), key=lambda r: (r[0], r[1], r[3])
    )
    if not whole:
        return {}, None
    w = len(whole[0][2]) // parts
    cut = lambda v, p: v[p * w:(p + 1) * w]
    book = [[cut(r[2], p) for r in whole[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda p, part: min((far(part, e), k) for k, e in enumerate(book[p]))
    for _ in range(rounds):
        members = defaultdict(list)
        for r in whole:
            for p in range(parts):
                members[p, near(p, cut(r[2], p))[1]].append(cut(r[2], p))
        for (p, k), found in members.items():
            book[p][k] = [sum(x) // len(found) for x in zip(*found)]
    out = defaultdict(list)
    for null, i, v, _ in whole:
        best = [near(p, cut(v, p)) for p in range(parts)]
        out[None if null else i].append((bytes(k for _, k in best), sum(d for d, _ in best)))
    text = ",".join(str(x) for p in book for e in p for x in e)
    return {k: sorted(v) for k, v in out.items()}, hashlib.sha256(text.encode()).hexdigest()


def found(made):
    out = defaultdict(list)
    for r in made.codes.collect():
        out[r["id"]].append((bytes(r["code"]), r["error"]))
    return {k: sorted(v) for k, v in out.items()}


def numbers(rng, n=32):
    # Sums of eighths are exact in single precision, and ties are common.
    return [rng.randrange(-24, 24) / 8 for _ in range(n)]


@pytest.mark.parametrize("size", [3, 64, 300])
def test_against_plain_arithmetic(frame, size, monkeypatch):
    rng = random.Random(size)
    rows = [(i * 13 % 1009, numbers(rng), i % 3) for i in range(size)]
    made = vectorcodes.compress(frame(rows))
    codes, digest = plain(rows)
    assert found(made) == codes and made.sha256() == digest


def test_odd_rows(frame):
    rng = random.Random(5)
    same = numbers(rng)
    rows = [(i, numbers(rng), None) for i in range(70)] + [(7, same, 1)] * 3 + [(None, numbers(rng), 2), (None, same, 2)]
    bad = [(90, None, 1), (91, [None] + same[1:], 1), (92, [math.nan] + same[1:], 1), (93, [math.inf] + same[1:], 1)]
    made = vectorcodes.compress(frame(rows + bad))
    codes, digest = plain(rows)
    assert found(made) == codes and made.sha256() == digest


def test_other_lengths_keep_a_row(frame):
    rng = random.Random(6)
    rows = [(i, numbers(rng), 0) for i in range(2, 20)]
    made = vectorcodes.compress(frame(rows + [(0, [1.0] * 7, 0), (1, [], 0), (50, [0.0] * 16, 0)]))
    out = {r["id"]: (r["code"] and bytes(r["code"]), r["error"]) for r in made.codes.collect()}
    assert out.pop(0) == out.pop(1) == out.pop(50) == (None, None)
    assert {k: [v] for k, v in out.items()} == plain(rows)[0]


def test_empty(frame):
    assert vectorcodes.compress(frame([])).codes.collect() == []
    assert vectorcodes.compress(frame([(1, None, 0), (2, [], 0)])).codes.where("code IS NOT NULL").collect() == []


def test_too_large(frame):
    with pytest.raises(ValueError, match="long"):
        vectorcodes.compress(frame([(1, [1e30] * 16, 0)]))


def test_totals_of_groups_with_nulls(spark):
    rows = spark.createDataFrame([(i, None if i % 3 else i % 2, i) for i in range(60)] + [(None, 5, None)], "id int, g int, error long")
    got = {(r["id"], r["g"], r["total"]) for r in vectorcodes.group_totals(rows, "g", "error", "total").collect()}
    sums = defaultdict(int)
    for i in range(60):
        sums[None if i % 3 else i % 2] += i
    want = {(i, None if i % 3 else i % 2, sums[None if i % 3 else i % 2]) for i in range(60)} | {(None, 5, None)}
    assert got == want


def test_decoded_vectors_are_as_far_as_the_error_says(frame):
    rng = random.Random(8)
    rows = {i: numbers(rng) for i in range(100)}
    made = vectorcodes.compress(frame([(i, v, 0) for i, v in rows.items()]))
    errors = {r["id"]: r["error"] for r in made.codes.collect()}
    for r in vectorcodes.decode(made).collect():
        far = sum((math.floor(256 * a) - 256 * b) ** 2 for a, b in zip(rows[r["id"]], r["vector"]))
        assert far == errors[r["id"]]
