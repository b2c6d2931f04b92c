"""Leaks against a plain alignment of every item with every document, and planted edits."""

import random

import numpy as np

from vacantia.llm import decontamination as dec
from vacantia.llm import queries


def smith_waterman(a, b):
    best, last = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(max(0, last[j] + (2 if x == y else -1), last[j + 1] - 1, row[j] - 1))
        best, last = max(best, max(row)), row
    return best / (2 * len(a))


def test_alignment_equals_plain_one():
    rng = random.Random(2)
    pairs = []
    for _ in range(200):
        a = [rng.randrange(1, 6) for _ in range(rng.randrange(1, 15))]
        b = [rng.randrange(1, 6) for _ in range(rng.randrange(0, 20))]
        pairs.append((a, b))
    got, _ = dec.align([np.array(a, np.uint64) for a, _ in pairs], [np.array(b, np.uint64) for _, b in pairs])
    assert np.allclose(got, [smith_waterman(a, b) for a, b in pairs])


def _words(rng, n):
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 5))) for _ in range(n)]


def test_planted_edits_and_clean_documents(spark, make):
    rng = random.Random(6)
    items = [(i, _words(rng, 40)) for i in range(30)] + [(30, ["only", "two"]), (31, ["one"] + _words(rng, 3))]
    docs, want = [], set()
    for i in range(300):
        words = _words(rng, rng.randrange(60, 200))
        if i % 3 == 0:
            item, own = items[i % 30]
            own = list(own)
            for at in range(3, 40, 7):
                own[at] = rng.choice(["zz", own[at] + "q"])
            if i % 2:
                del own[20:22]
            at = rng.randrange(len(words))
            words[at:at] = own
            want.add((i, item))
        docs.append((i, " ".join(words).title() + "."))
    docs.append((900, "it is Only, two here"))
    want.add((900, 30))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    frame = make(docs, extra=("key", "item_id", "score"))
    got = dec.leaks(frame, bench).collect()
    assert {(r["id"], r["item_id"]) for r in got} == want
    assert all(r["score"] >= dec.MIN_SCORE for r in got)
    clean = dec.keep_clean(frame, bench)
    assert clean.columns == frame.columns
    assert {r["doc_id"] for r in clean.collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_query_equals_plain_search(spark, folder, documents):
    words = dec.Words()
    items = [(r["item_id"], words(r["text"])) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    want = set()
    for doc_id, text, _ in documents:
        own = words(text).tolist()
        known = set(own)
        for item_id, item in items:
            shared = sum(w in known for w in item.tolist())
            # A score needs as many shared words as its share of matches.
            if len(item) and shared >= dec.MIN_SCORE * len(item) and smith_waterman(item.tolist(), own) >= dec.MIN_SCORE:
                want.add((doc_id, item_id))
    got = queries.QUERIES["op9_decontamination"](spark, folder).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want
    assert len(got) == len(want)


def test_a_copied_item_is_found_in_every_copy(spark, make):
    rng = random.Random(8)
    item = " ".join(_words(rng, 30))
    bench = spark.createDataFrame([(1, item), (2, None), (3, "  ")], "item_id int, text string")
    frame = make([(i, f"{i} {item}") for i in range(500)] + [(1000, None), (1001, ""), (1002, "x " * 100_000)])
    assert dec.leaks(frame, bench).count() == 500


def test_blocks_and_empty_tables(spark, make, monkeypatch):
    rng = random.Random(1)
    texts = [" ".join(_words(rng, 20)) for _ in range(6)]
    bench = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    frame = make([(i, t) for i, t in enumerate(texts)] * 2)
    monkeypatch.setattr(dec, "BLOCK_WORDS", 45)
    assert len(list(dec.blocks(bench, "item_id", "text"))) == 3
    assert sorted((r["id"], r["item_id"]) for r in dec.leaks(frame, bench).collect()) == sorted([(i, i) for i in range(6)] * 2)
    assert dec.leaks(make([]), bench).collect() == []
    assert dec.leaks(frame, bench.limit(0)).collect() == []
    assert dec.keep_clean(frame, bench.limit(0)).count() == 12


def test_edited_copies_beside_exact_ones_equal_the_plain_alignment(spark, make):
    rng = random.Random(9)
    items = [(i, _words(rng, 48)) for i in range(12)]
    docs = []
    for i, own in items:
        docs += [(10 * i + k, " ".join(own)) for k in range(1 + i % 3)]
        for step in (4, 5, 6):
            edited = [f"edit{i}x{step}x{at}" if at % step == step - 1 else w for at, w in enumerate(own)]
            docs.append((10 * i + step, " ".join(_words(rng, 30) + edited + _words(rng, 30))))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    want = {
        (d, i): score for d, text in docs for i, own in items
        if (score := smith_waterman(own, text.split())) >= dec.MIN_SCORE
    }
    assert all((10 * i + step, i) in want for i, _ in items for step in (4, 5, 6))
    got = dec.leaks(make(docs), bench).collect()
    assert {(r["id"], r["item_id"]): r["score"] for r in got} == want
    assert len(got) == len(want)


def test_long_passages_of_longer_items(spark, make):
    rng = random.Random(10)
    items = [(1, [f"a{i}" for i in range(200)]), (2, [f"b{i}" for i in range(1000)])]
    docs = [
        (1, items[0][1][40:150]), (2, items[1][1][300:800]), (3, items[1][1][:50]), (4, items[0][1][100:149]),
        (5, items[1][1][:40] + ["edit"] + items[1][1][41:60]),
    ]
    docs = [(i, " ".join(_words(rng, 20) + w + _words(rng, 20))) for i, w in docs]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")
    got = {(r["id"], r["item_id"]): r["score"] for r in dec.leaks(make(docs), bench).collect()}
    assert got == {(1, 1): 0.55, (2, 2): 0.5, (3, 2): 0.05, (5, 2): (2 * 59 - 1) / 2000}


def test_short_items_with_every_edit(spark, make):
    """Items of 4 to 12 words with one and two words replaced, left out or put in, against the plain alignment."""
    items, docs = [], []
    for n in range(4, 13):
        own = [f"w{n}x{i}" for i in range(n)]
        items.append((n, own))
        edits = [[i] for i in range(n)] + [[i, j] for i in range(n) for j in range(i)]
        for at in edits:
            docs.append([w if i not in at else "other" for i, w in enumerate(own)])
            docs.append([w for i, w in enumerate(own) if i not in at])
        docs += [own[:i] + ["other"] + own[i:] for i in range(n)]
    rows = [(d, " ".join(["before", "it"] + words + ["after", "it"])) for d, words in enumerate(docs)]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id smallint, text string")
    want = {
        (d, i) for (d, text) in rows for i, own in items
        if own[0][:-2] in text and smith_waterman(own, text.split()) >= dec.MIN_SCORE
    }
    got = dec.leaks(make(rows), bench).collect()
    assert {(r["id"], r["item_id"]) for r in got} == want and len(want) > 300


def test_the_aligned_passage_is_reported(spark, make):
    own = [f"w{i}" for i in range(8)]
    docs = [(1, ["a"] + own + ["b"] * 5), (2, ["a"] * 4 + own[:3] + ["edit"] + own[4:] + ["b"]), (3, own[:7]), (4, ["x"] * 30 + own[1:])]
    bench = spark.createDataFrame([("i", " ".join(own))], "item_id string, text string")
    got = dec.leaks(make([(i, " ".join(w)) for i, w in docs]), bench).collect()
    assert {r["id"]: (r["from_word"], r["past_word"]) for r in got} == {1: (1, 9), 2: (4, 12), 3: (0, 7), 4: (30, 37)}
