"""SimHash near-duplicates by tiled exact comparison.

Every document gets a 64-bit fingerprint of its three-word shingles. Distinct fingerprints are dealt into
tiles by the population counts of their halves; a tile meets only tiles whose counts differ by at most the
radius in sum, since each differing bit moves a half's count by one. A large tile is cut into chunks, so a
pair of chunks is always a bounded piece of work. Within a pair, numpy compares blocks by exclusive or and
bit count, again skipping blocks whose counts (now of four quarters) are too far apart. A pair returns a
spanning forest of its links, not the links, and the components of all forests are found by star rounds.

Defined results: a null or wordless text has fingerprint zero, which links like any other; repeated rows
get equal rows; a null id is never a component's least id unless it has no other; other columns are never
read by ``near_duplicates`` and all are kept by ``keep_one``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacantia.llm.common import components, fresh, row_key, settle
from vacantia.session import fixed_table

SHINGLE = 3
SEED = 42
RADIUS = 3
#: Fingerprints of one chunk of a tile at most, on average.
CHUNK = 8192
#: Fingerprints of a block within a chunk.
BLOCK = 256


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a text in UTF-8, as a signed number."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest
    if n < 2:
        hashes = np.array([digest(joined, seed)], np.uint64)
    else:
        starts = np.zeros(len(words) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1, out=starts[1:])
        spans = zip(starts[:n].tolist(), (starts[shingle:] - 1).tolist())
        hashes = np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    bits = np.packbits(2 * counts > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def _fingerprint_batches(batches):
    for batch in batches:
        texts = (t.as_buffer() for t in batch.column("text"))
        values = [fingerprint(b.to_pybytes()) if b else 0 for b in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("id"), pa.array(values, pa.int64())], ["key", "id", "fp"]
        )


def fingerprints(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, id, fp) of every row; key is the row key of id and text."""
    rows = documents.select(
        row_key(id_col, text_col).alias("key"), F.col(id_col).alias("id"), F.col(text_col).alias("text")
    )
    return rows.mapInArrow(_fingerprint_batches, f"key long, id {dict(rows.dtypes)['id']}, fp long")


def _quarters(values: np.ndarray) -> np.ndarray:
    return np.bitwise_count(values.view(np.uint16).reshape(-1, 4)).astype(np.int16)


def _boxes(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.arange(0, len(counts), BLOCK)
    return np.minimum.reduceat(counts, edges), np.maximum.reduceat(counts, edges)


def tile_links(left: np.ndarray, right: np.ndarray | None, radius: int = RADIUS) -> list[tuple[int, int]]:
    """A spanning forest of the links between two chunks, or within one if there is no right one."""
    both = left if right is None else np.concatenate([left, right])
    parent = np.arange(len(both))

    def ordered(values, shift):
        counts = _quarters(values)
        order = np.lexsort(counts.T)
        return values[order], counts[order], order + shift

    a, a_counts, a_at = ordered(left, 0)
    b, b_counts, b_at = (a, a_counts, a_at) if right is None else ordered(right, len(left))
    (a_lo, a_hi), (b_lo, b_hi) = _boxes(a_counts), _boxes(b_counts)
    apart = np.maximum(a_lo[:, None] - b_hi[None], b_lo[None] - a_hi[:, None])
    near = np.maximum(apart, 0).sum(axis=2) <= radius
    for i, j in np.argwhere(near):
        if right is None and j < i:
            continue
        x, y = a[i * BLOCK : (i + 1) * BLOCK], b[j * BLOCK : (j + 1) * BLOCK]
        r, c = np.nonzero(np.bitwise_count(x[:, None] ^ y[None]) <= radius)
        if not len(r):
            continue
        u, v = parent[a_at[i * BLOCK + r]], parent[b_at[j * BLOCK + c]]
        apart_yet = u != v
        if not apart_yet.any():
            continue
        for p, q in np.unique(np.stack([u[apart_yet], v[apart_yet]], axis=1), axis=0).tolist():
            while parent[p] != p:
                p = int(parent[p])
            while parent[q] != q:
                q = int(parent[q])
            parent[max(p, q)] = min(p, q)
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
    tied = np.nonzero(parent != np.arange(len(both)))[0]
    return list(zip(both[tied].tolist(), both[parent[tied]].tolist()))


def _tile_batches(batches):
    """Rows come sorted by (t1, t2, side); a pair of chunks may span batches."""
    kinds = ["t1", "t2", "side", "fp"]
    held: dict[str, list] = {k: [] for k in kinds}

    def links(t1, t2, side, fp):
        fp = fp.astype(np.int64).view(np.uint64)
        if t1 == t2:
            return tile_links(fp, None)
        return tile_links(fp[side == 0], fp[side == 1]) if 0 < side.sum() < len(side) else []

    def out(pairs):
        signed = np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(signed[:, 0]), pa.array(signed[:, 1])], ["u", "v"])

    def flush(cols, upto):
        edges = np.nonzero((np.diff(cols["t1"][:upto]) != 0) | (np.diff(cols["t2"][:upto]) != 0))[0] + 1
        found = []
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), upto]):
            found += links(cols["t1"][a], cols["t2"][a], cols["side"][a:b], cols["fp"][a:b])
        return out(found)

    for batch in batches:
        if not batch.num_rows:
            continue
        new = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in kinds}
        if held["t1"] and (held["t1"][0][0], held["t2"][0][0]) == (new["t1"][-1], new["t2"][-1]):
            for k in kinds:
                held[k].append(new[k])
            continue
        cols = {k: np.concatenate([*held[k], new[k]]) for k in kinds}
        last = (cols["t1"] == cols["t1"][-1]) & (cols["t2"] == cols["t2"][-1])
        start = int(np.argmax(last))
        if start:
            yield flush(cols, start)
        held = {k: [cols[k][start:]] for k in kinds}
    if held["t1"]:
        cols = {k: np.concatenate(held[k]) for k in kinds}
        yield flush(cols, len(cols["t1"]))


def links(distinct: DataFrame, radius: int = RADIUS, chunk: int = CHUNK) -> DataFrame:
    """(u, v): links that span every component of fingerprints within the radius.

    The table of tiles has at most 33 x 33 rows, whatever the number of fingerprints.
    """
    spark = distinct.sparkSession
    low = F.lit((1 << 32) - 1)
    tiled = distinct.select(
        "fp", (F.bit_count(F.shiftrightunsigned("fp", 32)) * 33 + F.bit_count(F.col("fp").bitwiseAND(low))).alias("tile")
    )
    sizes = {r["tile"]: -(-r["count"] // chunk) for r in tiled.groupBy("tile").count().collect()}
    pairs = [
        (a, sizes[a], b, sizes[b])
        for a in sizes for b in sizes
        if abs(a // 33 - b // 33) + abs(a % 33 - b % 33) <= radius
    ]
    if not pairs:
        return spark.createDataFrame([], "u long, v long")
    near = fixed_table(spark, pairs, "tile, chunks, other, other_chunks")
    dealt = tiled.join(F.broadcast(near), "tile").select(
        "fp", "tile", "other", F.pmod(F.xxhash64("fp"), F.col("chunks")).alias("i"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("other_chunks").cast("long") - 1)).alias("j"),
    )
    own = F.col("tile").cast("long") * (1 << 40) + F.col("i")
    met = F.col("other").cast("long") * (1 << 40) + F.col("j")
    work = dealt.select(
        F.least(own, met).alias("t1"), F.greatest(own, met).alias("t2"),
        F.when(own <= met, 0).otherwise(1).cast("int").alias("side"), "fp",
    )
    return (
        work.repartition("t1", "t2").sortWithinPartitions("t1", "t2", "side")
        .mapInArrow(_tile_batches, "u long, v long")
    )


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, id, fp, component): component is the least id reachable over links."""
    prints = settle(fingerprints(documents, id_col, text_col), "simhash")
    distinct = settle(prints.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct")
    roots = components(links(distinct))
    rooted = distinct.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    classes = settle(rooted.join(least, "root").select("fp", "component"), "simhash-classes")
    return prints.join(classes, "fp").select("key", "id", "fp", "component")


def keep_one(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component, with all columns: that of the least id; of rows that share the id, one."""
    key, tie = fresh(documents, "row_key"), fresh(documents, "row_tie")
    found = near_duplicates(documents, id_col, text_col)
    first = found.where(F.col("id").eqNullSafe(F.col("component"))).groupBy("component").agg(F.min("key").alias(key))
    kept = documents.withColumn(key, row_key(id_col, text_col)).join(first.select(key).distinct(), key, "left_semi")
    # Rows equal in id and text can differ in other columns; the least of them stays.
    # Maps have no order of their own; rows that hold one are ordered as they are spelled.
    mapped = any("map<" in kind for _, kind in documents.dtypes)
    least = F.min_by(tie, F.to_json(tie)) if mapped else F.min(tie)
    return kept.withColumn(tie, F.struct(*documents.columns)).groupBy(key).agg(least.alias(tie)).select(f"{tie}.*")
