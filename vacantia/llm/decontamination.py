"""Benchmark decontamination: n-gram hits, then Smith-Waterman alignment.

Test items are taken in blocks of a bounded number of words; each block meets all documents in one pass,
which joins document passages to items over word n-grams: hits of one item on nearby diagonals make a
candidate, one hit is enough. A copy with replaced or left out words that reaches the threshold holds a run of three words of an
item of ``LONG`` words or more, and one of two words of a shorter item, so seeds are runs of three or two. Every candidate is
aligned with its item, but for those whose words cannot reach the threshold: an alignment needs as many
shared words as it is worth. Edits, gaps and replaced words lower the score, which is the alignment's share of the
item's own. An item is leaked by a document if the score reaches the threshold, or if the alignment is worth a
number of verbatim words, whatever share of a long item they are. How many documents hold an n-gram decides nothing.
The passage reported is the aligned one, from its first matching word to past its last.

Defined results: null or empty texts and items match nothing; repeated rows get equal rows; an item shorter
than an n-gram is its own seed; other columns are never read by ``leaks`` and all are kept by ``keep_clean``.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from vacantia.llm.common import fresh, row_key, settle

NGRAM = 3
#: Words from which an item's seeds are n-grams; a shorter one's are pairs of words.
LONG = 9
#: Least alignment score of a leak.
MIN_SCORE = 0.6
#: An alignment worth so many verbatim words is a leak whatever share of its item it is.
LEAST_WORDS = 50
MATCH, MISMATCH, GAP = 2, -1, -1
#: Words of the items of one block; a longer item is a block of its own.
BLOCK_WORDS = 200_000

_WORD = re.compile(r"\w+")
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], np.uint64)


class Words:
    """Hashes of the words of a text; the cache is emptied when it is large."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        words = _WORD.findall((text or "").lower())
        known = self.known
        if len(known) > 300_000:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def grams(words: np.ndarray, n: int = NGRAM) -> np.ndarray:
    """A hash for each run of n words; a shorter text has one for the whole of it."""
    size = min(n, len(words))
    if not size:
        return words
    out = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        out = (out ^ words[i : len(words) - size + 1 + i]) * _MIX[i]
        out ^= out >> np.uint64(29)
    return out


class Filter:
    """Where values of a sorted set stand; a bit table passes over most of the others."""

    def __init__(self, values: np.ndarray):
        self.values = np.unique(values)
        self.bits = max(16, int(len(self.values)).bit_length() + 4)
        self.table = np.zeros(1 << self.bits, bool)
        self.table[self.values >> np.uint64(64 - self.bits)] = True

    def places(self, found: np.ndarray) -> np.ndarray:
        some = np.nonzero(self.table[found >> np.uint64(64 - self.bits)])[0]
        at = np.searchsorted(self.values, found[some])
        at[at == len(self.values)] = 0
        return some[self.values[at] == found[some]] if len(self.values) else some


def seed_size(n: int) -> int:
    """Words of a seed of an item of n words."""
    return min(n, NGRAM if n >= LONG else 2)


def align(items: list[np.ndarray], passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman score of each pair over the score of the item with itself, row by row for all pairs, and the
    first place past the best alignment in the passage."""
    rows, columns = max(map(len, items)), max(map(len, passages))
    a = np.zeros((len(items), rows), np.uint64)
    b = np.zeros((len(items), columns), np.uint64)
    inside = np.zeros((len(items), rows), bool)
    filled = np.zeros((len(items), columns), bool)
    for i, (x, y) in enumerate(zip(items, passages)):
        a[i, : len(x)], inside[i, : len(x)] = x, True
        b[i, : len(y)], filled[i, : len(y)] = y, True
    slope = np.arange(columns, dtype=np.int32) * -GAP
    last = np.zeros((len(items), columns + 1), np.int32)
    best, past = np.zeros(len(items), np.int32), np.zeros(len(items), np.int64)
    for r in range(rows):
        same = (b == a[:, r : r + 1]) & filled & inside[:, r : r + 1]
        now = np.maximum(last[:, :-1] + np.where(same, MATCH, MISMATCH), last[:, 1:] + GAP)
        np.maximum(now, 0, out=now)
        # The best gap to the left: a running maximum along a slope.
        now = np.maximum.accumulate(now + slope, axis=1) - slope
        last[:, 1:] = now
        top = np.where(inside[:, r], now.max(axis=1), 0)
        more = np.nonzero(top > best)[0]
        past[more] = now[more].argmax(axis=1) + 1
        best[more] = top[more]
    return best / (MATCH * np.array([len(x) for x in items])), past


def passage_of(item: np.ndarray, passage: np.ndarray, past: int) -> tuple[int, int]:
    """Where the best alignment that ends before ``past`` begins and ends in the passage: read backwards, it ends at its
    beginning."""
    _, length = align([item[::-1]], [passage[:past][::-1]])
    return past - int(length[0]), past


class Block:
    """Items of one block and where each n-gram stands in them."""

    def __init__(self, items: list[tuple]):
        words = Words()
        self.ids = [i for i, _ in items]
        self.words = [words(text) for _, text in items]
        self.grams = [grams(w, seed_size(len(w))) for w in self.words]
        self.sizes = sorted({seed_size(len(w)) for w in self.words})
        self.filter = Filter(np.concatenate([np.zeros(0, np.uint64), *self.grams]))
        self.places = defaultdict(list)
        for i, own in enumerate(self.grams):
            for at, g in enumerate(own.tolist()):
                self.places[g].append((i, at))

    def least(self, item: int, min_score: float) -> float:
        """Score from which an alignment with the item is a leak."""
        return min(min_score, LEAST_WORDS / len(self.words[item]))

    def bound(self, item: int, passage: np.ndarray) -> float:
        """No alignment of the item with the passage has a higher score: each match takes a word of both."""
        own = self.words[item]
        return min(int(np.isin(own, passage).sum()), int(np.isin(passage, own).sum())) / len(own)

    def hits(self, words: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, from, past) of each cluster of diagonals."""
        diagonals: dict[int, list[int]] = defaultdict(list)
        for size in self.sizes:
            found = grams(words, size) if len(words) >= size else words[:0]
            for at in self.filter.places(found).tolist():
                for item, place in self.places[int(found[at])]:
                    if seed_size(len(self.words[item])) == size:
                        diagonals[item].append(at - place)
        out = []
        for item, shifts in sorted(diagonals.items()):
            n = len(self.words[item])
            slack = 4 + n // 3
            shifts.sort()
            start = 0
            for i in range(1, len(shifts) + 1):
                if i == len(shifts) or shifts[i] - shifts[i - 1] > slack or shifts[i] - shifts[start] > n:
                    out.append((item, max(0, shifts[start] - slack), min(len(words), shifts[i - 1] + n + slack)))
                    start = i
        return out


def blocks(benchmark: DataFrame, id_col: str, text_col: str):
    """The test items block by block; a block holds BLOCK_WORDS words, or one longer item."""
    held, size = [], 0
    for row in benchmark.select(id_col, text_col).where(F.col(text_col).isNotNull()).toLocalIterator():
        n = len(_WORD.findall(row[1]))
        if not n:
            continue
        if held and size + n > BLOCK_WORDS:
            yield Block(held)
            held, size = [], 0
        held.append((row[0], row[1]))
        size += n
    if held:
        yield Block(held)


def _scan(rows: DataFrame, block: Block, min_score: float, item_type: DataType) -> DataFrame:
    """One pass over all documents: the best leak of each document and item of the block."""
    kind, item_type = to_arrow_type(item_type), item_type.simpleString()

    def scan(batches):
        words = Words()
        for batch in batches:
            ids, keys = batch.column("id"), batch.column("key")
            source, item_ids, scores, starts, pasts = [], [], [], [], []
            waiting, widest, best = [], 0, {}

            def flush():
                scores, pasts = align([block.words[w[1]] for w in waiting], [w[3] for w in waiting])
                for (row, item, start, passage), score, past in zip(waiting, scores.tolist(), pasts.tolist()):
                    if score < block.least(item, min_score) or -score > best.get((row, item), (1,))[0]:
                        continue
                    a, b = passage_of(block.words[item], passage, past)
                    found = (-score, start + a, start + b)
                    best[row, item] = min(found, best.get((row, item), found))

            for row, text in enumerate(batch.column("text")):
                hashes = words(text.as_py())
                for item, start, past in block.hits(hashes):
                    passage = hashes[start:past]
                    if block.bound(item, passage) < block.least(item, min_score):
                        continue
                    widest = max(widest, len(passage))
                    waiting.append((row, item, start, passage))
                    if widest * len(waiting) > 200_000:
                        flush()
                        waiting, widest = [], 0
            if waiting:
                flush()
            for (row, item), (score, start, past) in sorted(best.items()):
                source.append(row)
                item_ids.append(block.ids[item])
                scores.append(-score)
                starts.append(start)
                pasts.append(past)
            at = pa.array(source, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [keys.take(at), ids.take(at), pa.array(item_ids, kind), pa.array(scores, pa.float64()),
                 pa.array(starts, pa.int64()), pa.array(pasts, pa.int64())],
                ["key", "id", "item_id", "score", "from_word", "past_word"],
            )

    return rows.mapInArrow(scan, _LEAK.format(id=dict(rows.dtypes)["id"], item=item_type))


_LEAK = "key long, id {id}, item_id {item}, score double, from_word long, past_word long"


def leaks(
    documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", min_score: float = MIN_SCORE,
) -> DataFrame:
    """(key, id, item_id, score, from_word, past_word): the best passage of each document for each leaked item."""
    rows = documents.select(
        row_key(id_col, text_col).alias("key"), F.col(id_col).alias("id"), F.col(text_col).alias("text")
    )
    item_type = benchmark.schema[item_col].dataType
    found = None
    for block in blocks(benchmark, item_col, item_text_col):
        part = settle(_scan(rows, block, min_score, item_type), "leaks")
        found = part if found is None else found.unionByName(part)
    if found is None:
        shape = _LEAK.format(id=dict(rows.dtypes)["id"], item=item_type.simpleString())
        return documents.sparkSession.createDataFrame([], shape)
    return found


def keep_clean(
    documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """The rows of documents that leak no test item, with all their columns."""
    key = fresh(documents, "row_key")
    bad = leaks(documents, benchmark, id_col, text_col, **options).select(F.col("key").alias(key)).distinct()
    return documents.withColumn(key, row_key(id_col, text_col)).join(bad, key, "left_anti").select(documents.columns)
