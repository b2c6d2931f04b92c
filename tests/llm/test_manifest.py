"""Merkle manifest: roots and proofs against a plain tree, subsets of leaves, odd rows."""

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from vacantia.llm import manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def spell(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    return sha("".join(spell(v) for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)))


def climb(nodes):
    """The last node over ``nodes``, and each node's siblings as (left, right) by level."""
    paths = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, held = [], []
        for k in range(0, len(nodes), 16):
            run = nodes[k:k + 16]
            for j in range(len(run)):
                for i in under[k + j]:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1:])))
            up.append(sha("".join(run)))
            held.append([i for u in under[k:k + 16] for i in u])
        nodes, under = up, held
    return nodes[0], paths


def plain(rows, altered=lambda row: row["text"]):
    """(doc_id, leaf, subroot, root, proof, folded) of every row, sorted."""
    groups = defaultdict(list)
    for r in rows:
        groups[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), leaf(r, altered(r))))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    tops = {s: climb([x[2] for x in sorted(groups[s])]) for s in order}
    root, high = climb([tops[s][0] for s in order]) if order else (None, [])
    out = []
    for s, above in zip(order, high):
        for (known, i, own, other), path in zip(sorted(groups[s]), tops[s][1]):
            folded = other
            for left, right in path + above:
                folded = sha(left + folded + right)
            proof = sha("".join(a + b for a, b in path + above))
            out.append((i if known else None, own, tops[s][0], root, proof, folded))
    return sorted(out, key=repr)


def found(frame):
    return sorted(
        ((r["id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"]) for r in frame.collect()),
        key=repr,
    )


def run(frame, **changes):
    made = manifest.build(frame, **changes)
    return found(manifest.verify(made, manifest.prove(made)))


@pytest.mark.parametrize("size", [1, 16, 17, 257])
def test_against_a_plain_tree(spark, make, size):
    frame = make([(i * 7 % size, f"Text {i}", "hot" if i % 3 else f"s{i % 40}") for i in range(size)])
    assert run(frame) == plain(frame.collect())


def test_more_sources_than_a_run(spark, make):
    frame = make([(i, "a", f"source {i % 300}") for i in range(600)])
    assert run(frame) == plain(frame.collect())


def test_altered_rows_fold_to_another_root(spark, make):
    frame = make([(i, "ABC" if i % 2 else "abc") for i in range(40)])
    even = F.col("doc_id") % 4 < 2
    rows = run(frame, altered={"text": manifest.lowered(F.col("text"), even)})
    assert rows == plain(frame.collect(), lambda r: r["text"].lower() if r["doc_id"] % 4 < 2 else r["text"])
    wrong = {r[0] for r in rows if r[3] != r[5]}
    assert wrong == {i for i in range(40) if i % 4 == 1}


def test_some_leaves(spark, make):
    frame = make([(i, f"t{i}", f"s{i % 5}") for i in range(200)])
    made = manifest.build(frame)
    some = made.leaves.where("id % 37 = 0 OR id = 5")
    want = [r for r in plain(frame.collect()) if r[0] % 37 == 0 or r[0] == 5]
    assert found(manifest.verify(made, manifest.prove(made, some))) == want
    none = manifest.prove(made, made.leaves.where("false"))
    assert manifest.verify(made, none).collect() == []


def test_records_hold_every_node_by_its_digest(spark, make):
    made = manifest.build(make([(i, f"t{i}", f"s{i % 3}") for i in range(100)]))
    records = made.records.collect()
    assert all(sha("".join(r["children"])) == r["digest"] and len(r["children"]) <= 16 for r in records)
    assert len({(r["tree"], r["height"], r["digest"]) for r in records}) == len(records)


def test_odd_rows(spark, make):
    rows = [(1, None, None), (1, None, None), (None, "", None), (2, "é" * 50_000, "é"), (3, "x", ""), (3, "x", ""),
            (None, None, "z"), (4, "A", "z")] + [(9, "same", "copies")] * 40
    frame = make(rows, extra=("key", "at", "n", "ord", "leaf", "digest"))
    assert run(frame) == plain(frame.collect())


def test_empty(spark, make):
    assert run(make([])) == []
    assert manifest.build(make([])).root is None
