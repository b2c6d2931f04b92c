"""Sharding: whole, gapless, near equal bytes, equal texts together."""

import random
import re
import zlib
from collections import defaultdict

import pytest

from vacantia.llm import queries, shards


def _check(rows, texts, n):
    assert sorted((-1 if r["id"] is None else r["id"], r["size"]) for r in rows) == sorted(
        (-1 if i is None else i, len((t or "").encode()) + 16) for i, t in texts
    )
    slots, size = defaultdict(list), defaultdict(int)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        size[r["shard"]] += r["size"]
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert set(slots) <= set(range(n))
    return size


def test_query(spark, folder, documents):
    rows = queries.QUERIES["op6_sharding"](spark, folder).collect()
    crc = {i: zlib.crc32((t or "").encode()) for i, t, _ in documents}
    assert all(r["text_crc32"] == crc[r["doc_id"]] and r["law"] == "bytes" for r in rows)
    plain = [r.asDict() | {"id": r["doc_id"]} for r in rows]
    sizes = _check(plain, [(i, t) for i, t, _ in documents], 40)
    largest = max(r["size"] for r in rows)
    assert max(sizes.values()) - min(sizes[i] for i in range(40)) <= 2 * largest


@pytest.mark.parametrize("hot", [0, 400])
def test_near_equal_and_groups(spark, make, hot):
    rng = random.Random(1)
    texts = [(i, "x" * rng.randrange(200)) for i in range(800)] + [(1000 + i, "hot" * 30) for i in range(hot)]
    rows = shards.assign(make(texts), 7).collect()
    sizes = _check(rows, texts, 7)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r["size"] for r in rows)


def test_equal_texts_stay_together(spark, make):
    texts = [(i, f"text {i % 500}") for i in range(2000)]
    rows = shards.assign(make(texts), 5, tolerance=0.02).collect()
    _check(rows, texts, 5)
    where = defaultdict(set)
    for r in rows:
        where[r["text_crc32"]].add(r["shard"])
    assert all(len(v) == 1 for v in where.values())


def test_odd_rows(spark, make):
    texts = [(1, None), (1, None), (None, ""), (2, "é" * 50_000), (3, "a"), (3, "a"), (3, "b")]
    rows = shards.assign(make(texts, extra=("size", "key", "shard", "slot")), 40).collect()
    _check(rows, texts, 40)
    assert shards.assign(make([]), 40).collect() == []


def test_written_shards_hold_every_column(spark, make, tmp_path):
    frame = make([(i, f"t{i}") for i in range(50)], extra=("key",))
    shards.write_shards(frame, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 50 and set(back.columns) == set(frame.columns) | {"shard"}


def test_main_path_is_native(spark, folder):
    plan = queries.QUERIES["op6_sharding"](spark, folder)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
