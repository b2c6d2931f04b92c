"""Exact repeated passages by difference-cover blockwise suffix comparison.

Every byte covered by a string of ``length`` bytes that also starts elsewhere goes. Documents are gathered in
blocks of bounded size; matches never cross documents. A perfect difference cover modulo v has, for any two
places, exactly one shift below v that brings both onto the cover, so two equal strings hold two equal
suffix beginnings of ``length - v + 1`` bytes at cover places. Cover places are few (12 of 133).

1. Cover places are sorted by the first ``length - v + 1`` bytes of their suffix, one bucket of the sorted
   order at a time: the ranks that several places share are found.
2. Ties are resolved to the full depth by their whole surroundings, v - 1 bytes before to ``length`` after:
   places with equal surroundings settle all v windows around them at once. Classes of which members have
   different surroundings keep one place of each.
3. For those, single windows are sorted, again bucket by bucket, and the repeated ones found.

Buckets are of a bounded size whatever the text repeats: a block sends each distinct value once, and tells
repeats within itself by itself. Strings are compared by 64-bit hashes in two independent rounds.

Defined results: a null text is empty; repeated rows are repeats of each other; other columns are never read.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacantia.llm.common import partitions, settle
from vacantia.session import shared_dir

LENGTH = 200
# Perfect difference covers by their modulus.
COVERS = {
    1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18),
    57: (0, 1, 3, 13, 32, 36, 43, 52), 73: (0, 1, 3, 7, 15, 31, 36, 54, 63),
    91: (0, 1, 3, 9, 27, 49, 56, 61, 77, 81), 133: (0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109),
}
#: Bytes of the documents of one block, unless one document is longer, and of the values of one bucket.
BLOCK = 4 << 20
BUCKET = 24 << 20


def cover_of(length: int) -> int:
    """The largest modulus that leaves at least a third of the length to sort by."""
    return max(v for v in COVERS if v <= max(1, 2 * length // 3))


class Text:
    """The bytes of a block and the starts of its documents."""

    def __init__(self, data: bytes, sizes: np.ndarray):
        self.bytes = np.frombuffer(data, np.uint8)
        padded = data + bytes(16 - len(data) % 8)
        self.words = np.frombuffer(padded, "<u8")
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes

    def hash_at(self, at: np.ndarray, length: int) -> np.ndarray:
        """A 64-bit hash of the bytes from each place."""
        out = np.empty(len(at), np.uint64)
        for i in range(0, len(at), 1 << 18):
            out[i : i + (1 << 18)] = self._hash(at[i : i + (1 << 18)], length)
        return out

    def _hash(self, at, length):
        offsets = list(range(0, length - 7, 8))
        if length % 8 and length > 8:
            offsets.append(length - 8)
        value = np.full(len(at), length, np.uint64)
        for offset in offsets or [0]:
            place = at + offset
            word, shift = place >> 3, ((place & 7) << 3).astype(np.uint64)
            found = (self.words[word] >> shift) | ((self.words[word + 1] << np.uint64(1)) << (np.uint64(63) - shift))
            if length < 8:
                found &= np.uint64((1 << 8 * length) - 1)
            value = (value ^ found) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(32)
        value *= np.uint64(0xD6E8FEB86659FD93)
        return value ^ (value >> np.uint64(29))

    def cover_places(self, length: int) -> np.ndarray:
        """Cover places, counted from each document's start, with enough bytes after them."""
        v = cover_of(length)
        short = length - v + 1
        sizes = self.ends - self.starts
        most = int(sizes.max(initial=0))
        base = (np.arange(0, most + v, v)[:, None] + np.array(COVERS[v])).ravel()
        counts = np.searchsorted(base, sizes - short, "right")
        parts = [base[:n] + s for s, n in zip(self.starts.tolist(), counts.tolist()) if n]
        return np.concatenate(parts) if parts else np.zeros(0, np.int64)

    def cover_classes(self, length: int):
        """(places, distinct values in order, value of each place, repeated here)."""
        places = self.cover_places(length)
        values, which, counts = np.unique(
            self.hash_at(places, length - cover_of(length) + 1), return_inverse=True, return_counts=True
        )
        return places, values, which, counts > 1

    def windows(self, length: int, state: bytes, resolved: np.ndarray, active: np.ndarray):
        """(starts of settled windows, starts of windows to sort, their distinct values, value of each, repeated here)."""
        v = cover_of(length)
        places, pair = np.frombuffer(state, np.int32).reshape(2, -1).astype(np.int64)
        size = len(self.bytes)
        settled = _runs(size, places[resolved[pair]] - (v - 1), v)
        # One place of a pair is enough to stand for its windows.
        _, first = np.unique(pair, return_index=True)
        keep = first[active[pair[first]]]
        document = np.searchsorted(self.ends, places[keep], "right")
        low = np.maximum(places[keep] - (v - 1), self.starts[document])
        high = np.minimum(places[keep], self.ends[document] - length)
        some = high >= low
        open_ = np.nonzero(_runs(size, low[some], high[some] - low[some] + 1))[0]
        values, which, counts = np.unique(self.hash_at(open_, length), return_inverse=True, return_counts=True)
        return settled, open_, values, which, counts > 1


def _runs(size: int, starts: np.ndarray, lengths) -> np.ndarray:
    """True at the places of any run."""
    edges = np.zeros(size + 1, np.int32)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + lengths, -1)
    return np.cumsum(edges[:-1]) > 0


def _own_value(block: int, places: np.ndarray) -> np.ndarray:
    """A hash of the place itself, which no other place has."""
    seed = np.frombuffer(hashlib.blake2b(block.to_bytes(8, "little"), digest_size=8).digest(), np.uint64)
    value = (places.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ seed
    value = (value ^ (value >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return value ^ (value >> np.uint64(29))


def _by_bucket(values: np.ndarray, bits: int):
    """(bucket, from, past) of sorted values."""
    buckets = (values >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(values), np.int64)
    edges = np.nonzero(np.diff(buckets))[0] + 1
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(values)]):
        if b > a:
            yield int(buckets[a]), a, b


_MESSAGE = "block long, bucket int, data binary"


def _message(rows):
    blocks, buckets, data = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays(
        [pa.array(blocks, pa.int64()), pa.array(buckets, pa.int32()), pa.array(data, pa.binary())],
        ["block", "bucket", "data"],
    )


def _text(batch, row) -> Text:
    data = zstandard.decompress(batch.column("data")[row].as_py())
    return Text(data, batch.column("sizes")[row].values.to_numpy(zero_copy_only=False).astype(np.int64))


def gather(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Documents in blocks, written once: (block, ids, sizes, data), laid out by block for later joins."""
    spark = documents.sparkSession
    rows = documents.select(F.col(id_col).alias("id"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()

    def blocks(batches):
        part, n = TaskContext.get().partitionId() << 32, 0
        held, ids, size = [], [], 0

        def block():
            data = zstandard.compress(b"".join(held), 3)
            return pa.RecordBatch.from_arrays(
                [pa.array([part + n], pa.int64()), pa.array([pa.concat_arrays(ids).to_pylist()], pa.list_(ids[0].type)),
                 pa.array([[len(t) for t in held]], pa.list_(pa.int64())), pa.array([data], pa.binary())],
                ["block", "ids", "sizes", "data"],
            )

        for batch in batches:
            start = 0
            for row, text in enumerate(batch.column("text")):
                text = text.as_py()
                if held and size + len(text) > BLOCK:
                    ids.append(batch.column("id").slice(start, row - start))
                    yield block()
                    n, start = n + 1, row
                    held, ids, size = [], [], 0
                held.append(text)
                size += len(text)
            ids.append(batch.column("id").slice(start))
        if held:
            yield block()

    # Laid out by block: a later join with a block's answers moves the answers only.
    name, path = f"text_blocks_{uuid.uuid4().hex}", shared_dir(spark, "text-blocks")
    made = rows.mapInArrow(blocks, f"block long, ids array<{id_type}>, sizes array<long>, data binary")
    made.write.bucketBy(partitions(spark), "block").option("path", path).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table


def _shared_values(messages: DataFrame) -> DataFrame:
    """Answers for the sorted values of each block: a bit for each that another block has too."""

    def sort_bucket(group: pa.Table) -> pa.Table:
        values = [np.frombuffer(d.as_buffer(), np.uint64) for d in group.column("data")]
        all_ = np.sort(np.concatenate(values))
        shared = np.unique(all_[1:][all_[1:] == all_[:-1]])
        answers = []
        for own in values:
            at = np.searchsorted(shared, own)
            at[at == len(shared)] = 0
            hit = shared[at] == own if len(shared) else np.zeros(len(own), bool)
            answers.append(np.packbits(hit).tobytes())
        return pa.table({"block": group.column("block"), "bucket": group.column("bucket"), "data": pa.array(answers, pa.binary())})

    return messages.groupBy("bucket").applyInArrow(sort_bucket, _MESSAGE)


def _shared_pairs(messages: DataFrame) -> DataFrame:
    """Answers for the sorted (class, surroundings) pairs of each block, two bits for each.

    First: another block has the pair too. Second: its class has several surroundings, and this block is the
    first that has the pair.
    """

    def sort_bucket(group: pa.Table) -> pa.Table:
        pairs = [np.frombuffer(d.as_buffer(), np.uint64).reshape(2, -1) for d in group.column("data")]
        sizes = np.array([p.shape[1] for p in pairs])
        class_, around = np.concatenate(pairs, axis=1)
        block = np.repeat(group.column("block").to_numpy(), sizes)
        order = np.lexsort((block, around, class_))
        c, a = class_[order], around[order]
        new_pair = np.ones(len(c), bool)
        new_pair[1:] = (c[1:] != c[:-1]) | (a[1:] != a[:-1])
        new_class = np.ones(len(c), bool)
        new_class[1:] = c[1:] != c[:-1]
        number = np.cumsum(new_pair) - 1
        many = np.bincount(number)[number] > 1
        class_number = np.cumsum(new_class) - 1
        mixed = np.bincount(class_number[new_pair])[class_number] > 1
        resolved, active = np.empty(len(c), bool), np.empty(len(c), bool)
        resolved[order], active[order] = many, mixed & new_pair
        edges = np.cumsum(sizes) - sizes
        answers = [
            np.packbits(np.stack([resolved[s : s + n], active[s : s + n]])).tobytes()
            for s, n in zip(edges.tolist(), sizes.tolist())
        ]
        return pa.table({"block": group.column("block"), "bucket": group.column("bucket"), "data": pa.array(answers, pa.binary())})

    return messages.groupBy("bucket").applyInArrow(sort_bucket, _MESSAGE)


def _answers(frame: DataFrame, kind: int) -> DataFrame:
    return frame.select("block", F.struct(F.lit(kind).alias("kind"), "bucket", "data").alias("answer"))


def _with_answers(blocks: DataFrame, *answers: DataFrame) -> DataFrame:
    """Each block with all answers for it; there are at most as many as buckets."""
    union = answers[0]
    for more in answers[1:]:
        union = union.unionByName(more)
    return blocks.join(union.groupBy("block").agg(F.collect_list("answer").alias("answers")), "block", "left")


def _bits(batch, row, kind: int, sizes: list[tuple[int, int, int]], rows: int = 1) -> np.ndarray:
    """The answers of a kind put together in the order of the values they are for."""
    found = {a["bucket"]: a["data"] for a in batch.column("answers")[row].as_py() or () if a["kind"] == kind}
    parts = [
        np.unpackbits(np.frombuffer(found[k], np.uint8), count=rows * (b - a)).reshape(rows, -1).astype(bool)
        for k, a, b in sizes
    ]
    return np.concatenate(parts, axis=1) if parts else np.zeros((rows, 0), bool)


def _state(batch, row) -> tuple[bytes, list]:
    """A block's cover places that share a class, and the bucket bounds of their pairs."""
    for a in batch.column("answers")[row].as_py() or ():
        if a["kind"] == 0:
            n = int(np.frombuffer(a["data"][:8], np.int64)[0])
            bounds = np.frombuffer(a["data"][8 : 8 + 24 * n], np.int64).reshape(-1, 3).tolist()
            return a["data"][8 + 24 * n :], bounds
    return b"", []


def repeats(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH
) -> DataFrame:
    """Per row: id, n_bytes, spans (removed runs of bytes, end exclusive), kept_sha256."""
    v = cover_of(length)
    blocks = gather(documents, id_col, text_col)
    total = blocks.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b))).first()[0] or 0
    bits_for = lambda size: max(0, int(size // BUCKET).bit_length())
    bits = bits_for(total * len(COVERS[v]) * 8 // v)

    def cover(batches):
        for batch in batches:
            for row, block in enumerate(batch.column("block").to_pylist()):
                _, values, _, _ = _text(batch, row).cover_classes(length)
                yield _message([(block, k, values[a:b].tobytes()) for k, a, b in _by_bucket(values, bits)])

    ranks = settle(_shared_values(blocks.mapInArrow(cover, _MESSAGE)), "suffix-ranks")

    def surroundings(batches):
        for batch in batches:
            for row, block in enumerate(batch.column("block").to_pylist()):
                text = _text(batch, row)
                places, values, which, here = text.cover_classes(length)
                tied = (_bits(batch, row, 0, list(_by_bucket(values, bits)))[0] | here)[which]
                places, class_ = places[tied], values[which[tied]]
                document = np.searchsorted(text.ends, places, "right")
                whole = (places - (v - 1) >= text.starts[document]) & (places + length <= text.ends[document])
                # A place too near an end has surroundings of its own.
                around = _own_value(block, places)
                around[whole] = text.hash_at(places[whole] - (v - 1), length + v - 1)
                order = np.lexsort((around, class_))
                c, a = class_[order], around[order]
                new = np.ones(len(c), bool)
                new[1:] = (c[1:] != c[:-1]) | (a[1:] != a[:-1])
                pair = np.empty(len(c), np.int32)
                pair[order] = np.cumsum(new) - 1
                c, a = c[new], a[new]
                bounds = list(_by_bucket(c, bits))
                head = np.array([len(bounds)], np.int64).tobytes() + np.array(bounds, np.int64).tobytes()
                if len(places):
                    yield _message(
                        [(block, -1, head + np.stack([places.astype(np.int32), pair]).tobytes())]
                        + [(block, k, np.stack([c[s:e], a[s:e]]).tobytes()) for k, s, e in bounds]
                    )

    met = settle(_with_answers(blocks, _answers(ranks, 0)).mapInArrow(surroundings, _MESSAGE), "suffix-surroundings")
    states = _answers(met.where("bucket = -1"), 0)
    ties = _answers(settle(_shared_pairs(met.where("bucket >= 0")), "suffix-ties"), 1)

    def settled_windows(batch, row):
        text = _text(batch, row)
        state, bounds = _state(batch, row)
        resolved, active = _bits(batch, row, 1, bounds, 2)
        pair = np.frombuffer(state, np.int32).reshape(2, -1)[1]
        # A pair that stands twice in this block settles its places, too.
        resolved = resolved | (np.bincount(pair, minlength=len(resolved)) > 1)
        return text, *text.windows(length, state, resolved, active)

    def windows(batches):
        for batch in batches:
            for row, block in enumerate(batch.column("block").to_pylist()):
                _, _, _, values, _, _ = settled_windows(batch, row)
                yield _message([(block, k, values[a:b].tobytes()) for k, a, b in _by_bucket(values, bits)])

    last = settle(_shared_values(_with_answers(blocks, states, ties).mapInArrow(windows, _MESSAGE)), "suffix-windows")
    id_type = dict(blocks.dtypes)["ids"].removeprefix("array<").removesuffix(">")

    def remove(batches):
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for row in range(batch.num_rows):
                text, settled, open_, values, which, here = settled_windows(batch, row)
                shared = _bits(batch, row, 2, list(_by_bucket(values, bits)))[0] | here
                starts = settled
                starts[open_[shared[which]]] = True
                gone = _runs(len(text.bytes), np.nonzero(starts)[0], length)
                spans, kept = [], []
                for s, e in zip(text.starts.tolist(), text.ends.tolist()):
                    own = gone[s:e]
                    if own.any():
                        edges = np.nonzero(np.diff(np.concatenate([[False], own, [False]])))[0].reshape(-1, 2)
                        spans.append([{"start": a, "end": b} for a, b in edges.tolist()])
                        kept.append(hashlib.sha256(text.bytes[s:e][~own].tobytes()).hexdigest())
                    else:
                        spans.append([])
                        kept.append(hashlib.sha256(text.bytes[s:e].tobytes()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("ids")[row].values, batch.column("sizes")[row].values, pa.array(spans, span), pa.array(kept, pa.string())],
                    ["id", "n_bytes", "spans", "kept_sha256"],
                )

    return _with_answers(blocks, states, ties, _answers(last, 2)).mapInArrow(
        remove, f"id {id_type}, n_bytes long, spans array<struct<start:bigint,end:bigint>>, kept_sha256 string"
    )
