"""Fingerprints and components against brute force."""

import random

import numpy as np
import xxhash

from vacantia.llm import queries, simhash


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Least id reachable, by rows (id, print)."""
    values = sorted(set(prints.values()))
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    array = np.array(values, np.uint64)
    for v in values:
        for w in array[np.bitwise_count(array ^ np.uint64(v)) <= 3].tolist():
            a, b = find(v), find(w)
            root[max(a, b)] = min(a, b)
    least = {}
    for i, v in prints.items():
        least[find(v)] = min(i, least.get(find(v), i))
    return {i: least[find(v)] for i, v in prints.items()}


def test_query_equals_brute_force(spark, folder, documents):
    rows = queries.QUERIES["op2_simhash"](spark, folder).collect()
    prints = {i: brute_print(t) for i, t, _ in documents}
    assert {r["doc_id"]: r["fingerprint"] for r in rows} == {i: f"{v:016x}" for i, v in prints.items()}
    assert {r["doc_id"]: r["component_id"] for r in rows} == brute_components(prints)


def test_tiles_find_every_link(spark):
    rng = random.Random(3)
    prints = {}
    for base in range(60):
        value = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 60)):
            prints[len(prints)] = value
            for _ in range(rng.randrange(0, 4)):
                value ^= 1 << rng.randrange(64)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    distinct = spark.createDataFrame([(signed(v),) for v in set(prints.values())], "fp long")
    for chunk in (7, 8192):
        edges = simhash.links(distinct, chunk=chunk).collect()
        root = {signed(v): signed(v) for v in prints.values()}

        def find(v):
            while root[v] != v:
                v = root[v]
            return v

        for u, v in edges:
            root[find(u)] = find(v)
        groups = {}
        for i, want in brute_components(prints).items():
            groups.setdefault(want, set()).add(find(signed(prints[i])))
        assert all(len(g) == 1 for g in groups.values())
        assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_forest_of_a_dense_group_is_small():
    values = np.array([0] + [1 << b for b in range(64)] * 20, np.uint64)
    assert len(simhash.tile_links(values, None)) == len(values) - 1


def test_odd_rows(spark, make):
    long = " ".join(f"w{i}" for i in range(40_000))
    rows = [(5, None), (4, " \n"), (None, ""), (7, long), (7, long), (6, "a b"), (None, "A  B"), (9, "é É ß")]
    frame = make(rows, extra=("fp", "component", "key", "row_key"))
    out = simhash.near_duplicates(frame).collect()
    assert sorted((str(r["id"]), r["component"]) for r in out) == sorted(
        [("5", 4), ("4", 4), ("None", 4), ("7", 7), ("7", 7), ("6", 6), ("None", 6), ("9", 9)]
    )
    kept = simhash.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [4, 6, 7, 9]
    assert simhash.near_duplicates(make([])).collect() == []
    assert simhash.keep_one(make([(None, "x y"), (None, "x y")])).count() == 1


def test_rows_with_a_map_column(spark):
    rows = [(1, "one two three four", {"k": "b"}), (1, "one two three four", {"k": "a"}), (2, "one two three four", None),
            (3, "something else is here", {})]
    frame = spark.createDataFrame(rows, "doc_id long, text string, tags map<string,string>")
    out = simhash.keep_one(frame)
    assert out.columns == frame.columns
    assert sorted((r["doc_id"], r["tags"]) for r in out.collect()) == [(1, {"k": "a"}), (3, {})]
