"""Quality rules: cross-document line frequency within a host.

Each document's lines are normalised and hashed. A line that stands in too many different documents
of a host is furniture; it is taken out, and a document of which too little is left is rejected, as
is one that fails the base rules.

Defined results: a null text has no words and fails; a null host is a host of its own; repeated rows
get the same verdict, and copies and near copies of a whole text count as one document; lines without a word are
never removed; columns of any other name are kept by ``keep_good`` and never read.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacantia.llm.common import fresh, row_key, settle

#: Base rules: fewer words, or a larger share of words in repeated windows, fail.
MIN_WORDS = 50
MAX_REPEATED = 50
#: A line is furniture in more documents of a host than this many, and than this share of them.
LINE_DOCUMENTS = 20
LINE_SHARE = 0.05
#: A document is depleted if furniture lines hold more than this share of its words.
MAX_REMOVED = 0.8
#: Texts that a worker holds as Python values at once.
SLICE = 256
#: Parts over which the rows of one line are spread when they meet its verdict.
PARTS = 32
#: Keys are sought by this many remainders before any text is moved.
SLOTS = 1 << 20
#: Texts are near copies if their sets of word pairs have at least this Jaccard similarity.
NEAR = 0.95
# Minimum hashes by which near copies meet, and the bands of them.
_KEYS = np.array([(2 * k + 1) * 0x9E3779B97F4A7C15 % (1 << 64) for k in range(12)], np.uint64)
_BANDS = ((0, 1, 2), (3, 4, 5), (6, 7, 8), (9, 10, 11), (0, 3, 6), (1, 4, 9), (2, 7, 10), (5, 8, 11))

_SPACES = "\t\n\x0b\x0c\r "
_SYMBOLS = "#*$%&|<>"
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_DIGITS = re.compile(r"[0-9]+")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def repeated_words(words: list) -> int:
    """Words that lie in a three-word window found twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    names: dict = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.int64, len(words))
    if len(names) < 1 << 21:
        windows = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
    else:
        pairs = np.unique(ids[:-1] * len(names) + ids[1:], return_inverse=True)[1]
        windows = pairs[:-1] * len(names) + ids[2:]
    _, place, count = np.unique(windows, return_inverse=True, return_counts=True)
    again = count[place] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + n] |= again
    return int(covered.sum())


def word_pairs(words: list) -> np.ndarray:
    """Different 32-bit hashes of two words in a row, or of a lone word."""
    names = {w: xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass")) for w in set(words)}
    x = np.fromiter(map(names.__getitem__, words), np.uint64, len(words))
    if len(x) > 1:
        x = (x[:-1] * _KEYS[1]) ^ x[1:]
    x = (x ^ (x >> np.uint64(29))) * _KEYS[2]
    return np.unique((x >> np.uint64(32)).astype(np.uint32).view(np.int32))


def _normal(parts: list) -> str:
    """A line's words, whatever their case, digits and spaces."""
    return _DIGITS.sub("0", " ".join(parts).lower())


def text_pairs(text: str) -> np.ndarray:
    """The word pairs of the different lines of a text with a word."""
    lines = dict.fromkeys(_normal(parts) for x in text.split("\n") if (parts := _WORD.findall(x)))
    return word_pairs(" ".join(lines).split(" "))


def _line_hash(parts: list) -> int:
    """The hash of a normal line."""
    normal = _normal(parts)
    return _signed(xxhash.xxh64_intdigest(normal.encode("utf-8", "surrogatepass")))


def cut_lines(text: str, hashes) -> str:
    """The text without the lines of the given hashes."""
    gone = set(hashes)
    return "\n".join(x for x in text.split("\n") if not (parts := _WORD.findall(x)) or _line_hash(parts) not in gone)


def measure_text(text: str | None) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, line hashes, words per line)."""
    text = text or ""
    words = _WORD.findall(text)
    lines: dict[str, int] = {}
    seen: set[str] = set()
    dup = 0
    for line in text.split("\n"):
        parts = _WORD.findall(line)
        if not parts:
            continue
        if line in seen:
            dup += 1
        seen.add(line)
        normal = _normal(parts)
        lines[normal] = lines.get(normal, 0) + len(parts)
    hashes = [_signed(xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass"))) for x in lines]
    return (
        len(words),
        len(text) - sum(map(text.count, _SPACES)),
        sum(map(text.count, _SYMBOLS)),
        dup,
        repeated_words(words),
        hashes,
        list(lines.values()),
    )


_MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "hashes array<long>, counts array<long>"
)


def _slices(batches):
    """The batches in slices of few rows, so that a worker's memory does not grow with a batch."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            yield batch.slice(start, SLICE)


def _measure_batches(batches):
    for batch in _slices(batches):
        columns = list(zip(*[measure_text(t) for t in batch.column("text").to_pylist()]))
        kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())] * 2
        arrays = [batch.column("key"), batch.column("id"), batch.column("host")]
        arrays += [pa.array(c, k) for c, k in zip(columns, kinds)]
        names = ["key", "id", "host"] + [part.split()[0] for part in _MEASURES.split(", ")]
        yield pa.RecordBatch.from_arrays(arrays, names)


def _pair_batches(batches):
    for batch in _slices(batches):
        pairs = [text_pairs(t) for t in batch.column("text").to_pylist()]
        ends = np.concatenate([[0], np.cumsum([len(p) for p in pairs])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(pairs)))
        yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column("body"), lists], ["host", "body", "pairs"])


def _band_batches(batches):
    for batch in _slices(batches):
        rows = []
        for pairs in batch.column("pairs"):
            x = np.array(pairs.as_py(), np.int32).view(np.uint32).astype(np.uint64) + np.uint64(1)
            least = []
            for k in _KEYS:
                h = (x ^ k) * _KEYS[3]
                least.append(int(((h ^ (h >> np.uint64(32))) * _KEYS[4]).min()))
            rows.append([
                _signed(xxhash.xxh64_intdigest(repr((b, *[least[k] for k in band])))) for b, band in enumerate(_BANDS)
            ])
        arrays = [batch.column(c) for c in ("host", "body")] + [pa.array(rows, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, ["host", "body", "bands"])


def near_copies(bodies: DataFrame) -> DataFrame:
    """(host, body, first): the least body that a body is a near copy of, among the least of its buckets.

    ``bodies`` are (host, body, pairs) rows, one for each body of a host. Bodies that share a bucket only
    are compared with its least one pair by pair, so texts that merely share lines stay apart.
    """
    members = bodies.mapInArrow(_band_batches, "host string, body long, bands array<long>").select(
        "host", "body", F.explode("bands").alias("band")
    ).withColumn("part", F.pmod(F.col("body"), F.lit(PARTS)).cast("int"))
    members = settle(members, "quality-bands")
    least = (
        members.groupBy("host", "band").agg(F.min("body").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
        .select("host", "band", "first", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
    )
    met = members.join(least, ["host", "band", "part"]).where("body <> first").select("host", "body", "first").distinct()
    own = bodies.select("host", "body", F.col("pairs").alias("a"))
    other = bodies.select("host", F.col("body").alias("first"), F.col("pairs").alias("b"))
    common = F.size(F.array_intersect("a", "b"))
    return (
        met.join(own, ["host", "body"]).join(other, ["host", "first"])
        .where(common >= NEAR * (F.size("a") + F.size("b") - common))
        .groupBy("host", "body").agg(F.min("first").alias("first"))
    )


def texts_of(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(host, body, text) of the wanted (host, body, key) rows.

    Rows whose key shares its remainder with no wanted one stay where they are; at most ``SLOTS`` remainders are
    broadcast. The rest meets the wanted keys by a shuffle at any size.
    """
    slot = F.pmod("key", F.lit(SLOTS)).cast("int").alias("slot")
    slots = wanted.select(slot).distinct()
    likely = rows.select("key", "text", slot).join(F.broadcast(slots), "slot", "left_semi").select("key", "text")
    return likely.join(wanted.hint("merge"), "key").select("host", "body", "text").dropDuplicates(["host", "body"])


def judge(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    line_documents: int = LINE_DOCUMENTS, line_share: float = LINE_SHARE, max_removed: float = MAX_REMOVED,
) -> DataFrame:
    """Per row of documents: key (of id, host and text), id, the measures, removed_words, removed_lines (hashes, null
    if none), base_failed, kept.

    Lines are counted over different documents: copies and near copies of a whole text count once, so the lines
    of a large group of them are no furniture. Near copies are sought only among documents with a line that
    is furniture as counted without them. A line counted in more than ``line_documents``
    documents and ``line_share`` of its host's is removed; more than ``max_removed`` of the words
    removed rejects the document.
    """
    rows = documents.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(host_col).cast("string"), F.lit("\0")).alias("host"),
        F.col(text_col).alias("text"),
    )
    rows = rows.select(row_key("id", "host", "text").alias("key"), "id", "host", "text")
    id_type = dict(rows.dtypes)["id"]
    measured = settle(
        rows.mapInArrow(_measure_batches, f"key long, id {id_type}, host string, {_MEASURES}"), "quality"
    )
    measured = measured.withColumn("body", F.xxhash64("hashes"))
    lines = measured.where(F.size("hashes") > 0).select(
        "key", "host", "body", F.explode(F.arrays_zip("hashes", "counts")).alias("l")
    ).select("key", "host", "body", F.col("l.hashes").alias("line"), F.col("l.counts").alias("words"))
    totals = measured.select("host", "body").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("documents"))

    def frequent(seen):
        """Lines over the limits, once for each part; ``seen`` has a row for each line of a document."""
        return (
            seen.groupBy("host", "line").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > line_documents)
            .join(totals, "host").where(F.col("n") > line_share * F.col("documents"))
            .select("host", "line", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
        )

    hits = settle(
        lines.withColumn("part", F.pmod(F.col("key"), F.lit(PARTS)).cast("int"))
        .join(frequent(lines.select("host", "line", "body").distinct()), ["host", "line", "part"])
        .groupBy("key", "host", "line", "body", "part").agg(F.first("words").alias("words")),
        "quality-hits",
    )
    # Only documents with such a line have their word pairs found, in a second reading, and one of those alike.
    wanted = settle(hits.groupBy("host", "body").agg(F.min("key").alias("key")), "quality-wanted")
    bodies = settle(texts_of(rows, wanted).mapInArrow(_pair_batches, "host string, body long, pairs array<int>"), "quality-bodies")
    near = near_copies(bodies)
    counted = hits.select("host", "line", "body").distinct().join(near, ["host", "body"], "left").select(
        "host", "line", F.coalesce("first", "body").alias("document")
    ).distinct()
    removed = (
        hits.join(frequent(counted), ["host", "line", "part"]).groupBy("key").agg(
            F.sum("words").alias("removed_words"), F.collect_list("line").alias("removed_lines")
        )
    )
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED)
    return (
        measured.drop("hashes", "counts", "host", "body").join(removed, "key", "left")
        .withColumn("removed_words", F.coalesce("removed_words", F.lit(0)))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("removed_words") <= max_removed * F.col("n_words")))
    )


def keep_good(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", **limits
) -> DataFrame:
    """The rows of documents whose verdict is kept, with all their columns; their texts are without the lines that
    are furniture of their host."""
    key, host, lines = (fresh(documents, name) for name in ("row_key", "row_host", "row_lines"))
    verdicts = judge(documents, id_col, text_col, host_col, **limits)
    good = verdicts.where("kept").select(F.col("key").alias(key), F.col("removed_lines").alias(lines)).dropDuplicates([key])
    keyed = documents.withColumn(host, F.coalesce(F.col(host_col).cast("string"), F.lit("\0")))
    keyed = keyed.withColumn(key, row_key(id_col, host, text_col)).join(good, key)

    @F.pandas_udf("string")
    def cut(texts: pd.Series, hashes: pd.Series) -> pd.Series:
        return pd.Series([None if h is None else cut_lines(t, h) for t, h in zip(texts, hashes)], dtype=object)

    # Only texts that lose a line are sent to be cut.
    left = cut(F.when(F.col(lines).isNotNull(), F.col(text_col)), F.col(lines))
    return keyed.withColumn(text_col, F.coalesce(left, F.col(text_col))).select(documents.columns)
