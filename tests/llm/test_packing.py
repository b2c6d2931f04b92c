"""Pieces against the tokenizers library, and packings that are whole, gapless and tight."""

import bisect
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from vacantia.llm import packing, queries


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids_equal_the_tokenizers_file(tokenizer, documents):
    encode = packing.encoder(packing.default_vocabulary())
    rng = random.Random(9)
    odd = ["", " ", "\n\n \t", "<|endoftext|>", "hi <|endoftext|> there", "a<|endoftext|><|endoftext|>\n", " <|endoftext| >",
           "<<|endoftext|>|>  <|endoftext|>  x", "a" * 5000, "it's  I'LL", " x y", "日本語 🙂👩‍👩‍👧", "\r\n1234567 ½²", "\x00\x01�"]
    odd += ["".join(rng.choice(" \n\tab'sé1½日🙂.-_<|> ́") for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts = odd + [t or "" for _, t, _ in documents]
    for text, known in zip(texts, tokenizer.encode_batch(texts, add_special_tokens=False)):
        assert encode(text) == known.ids, text


def check_packing(rows, capacity):
    """Sequences are gapless from 0 and within the capacity; gives their number."""
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def decreasing(lengths, capacity):
    """Sequences that sequential best-fit decreasing takes."""
    gaps, n = [], 0
    for length in sorted(lengths, reverse=True):
        i = bisect.bisect_left(gaps, length)
        if i < len(gaps):
            gap = gaps.pop(i)
        else:
            gap, n = capacity, n + 1
        bisect.insort(gaps, gap - length)
    return n


def test_query_is_whole_and_tight(spark, folder, documents, tokenizer):
    rows = queries.QUERIES["op1_best_fit_packing"](spark, folder).collect()
    n = check_packing(rows, 1024)
    got = {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in rows}
    assert len(got) == len(rows)
    want, lengths = {}, []
    for doc_id, text, _ in documents:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        at, piece = 0, 0
        while at < len(ids):
            size = (len(ids) - at - 1) % 1024 + 1
            want[doc_id, piece] = (at, size, zlib.crc32(ids[at : at + size].tobytes()))
            lengths.append(size)
            at, piece = at + size, piece + 1
    assert got == want
    assert n <= decreasing(lengths, 1024) * 1.01 + 1


@pytest.mark.parametrize("kind", ["mixed", "small", "equal", "halves", "hot", "thirds"])
def test_packing_is_near_sequential_best_fit(spark, kind):
    rng = random.Random(4)
    lengths = {
        "mixed": [rng.randrange(1, 101) for _ in range(600)],
        "small": [rng.randrange(1, 12) for _ in range(500)],
        "equal": [30] * 300,
        "halves": [50] * 101,
        "hot": [37] * 200 + [rng.randrange(1, 60) for _ in range(300)],
        "thirds": [rng.choice([33, 34, 35]) for _ in range(300)],
    }[kind]
    items = spark.createDataFrame(list(enumerate(lengths)), "uid long, length long")
    rows = packing.pack(items, 100).collect()
    assert sorted(r["uid"] for r in rows) == list(range(len(lengths)))
    n = check_packing([{"sequence_id": r["bin"], "offset": r["offset"], "length": lengths[r["uid"]]} for r in rows], 100)
    assert n <= decreasing(lengths, 100) * 1.05 + 1


def test_odd_rows(spark, make):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "word " * 30_000), (4, "x"), (4, "x")]
    frame = make(rows, extra=("uid", "length", "piece", "sequence_id"))
    out = packing.pack_documents(frame, with_ids=True).collect()
    check_packing(out, 1024)
    assert sum(r["piece"] == 0 for r in out) == len(rows)
    assert all(len(r["ids"]) == r["length"] and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in out)
    assert packing.pack_documents(make([])).collect() == []
