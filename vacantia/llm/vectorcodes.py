"""Vector compression by codebooks, with part distances from per-dimension value dictionaries.

Components become integers. Vectors are kept in blocks: for each dimension the distinct integers of the block, its
dictionary, and for each vector their numbers. To compare a block with a codebook, the squared
differences of each dictionary value to all entries are tabulated once; the distance of a part is then gathered
from the tables by number and added up over the part's dimensions, without arithmetic on the components
themselves. A dictionary holds at most ``BLOCK`` values, whatever the number of vectors.

A round writes nothing: each task sums its blocks' parts by entry, Spark adds the sums, and the driver makes the next
codebooks. The driver sees ``entries`` vectors, and one row for each component of the codebooks.
All arithmetic is on integers and exact.

Defined results: rows whose vector is null or has null or non-finite components are left out; the entries begin as
the parts of the vectors with the least ids (null ids last, equal ids by their components); with fewer
vectors there are fewer entries; the width is that of the first vector whose length is a multiple of the number of
parts, and vectors of another length keep a row without code and error; components so large that an error would not
fit a long are refused; repeated rows are coded each; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacantia.llm.common import partitions, settle

#: Vectors of a block, and so the most values of a dictionary.
BLOCK = 4096
SCALE = 256

_BLOCKS = T.StructType(
    [
        T.StructField("values", T.ArrayType(T.LongType())),
        T.StructField("starts", T.ArrayType(T.IntegerType())),
        T.StructField("numbers", T.BinaryType()),
    ]
)


@dataclass(frozen=True)
class Compressed:
    """``codes``: id, the carried columns, code (an entry a part, as bytes) and error; ``codebooks`` by part,
    entry and position."""

    codes: DataFrame
    codebooks: np.ndarray

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.codebooks.ravel().tolist())).encode()).hexdigest()


def _whole(vector: Column) -> Column:
    """No null, infinite or undefined component."""
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))


def integers(vectors: np.ndarray) -> np.ndarray:
    """floor(256 x) of each component."""
    scaled = np.floor(vectors.astype(np.float64) * SCALE)
    limit = isqrt((1 << 62) // max(vectors.shape[1], 1)) // 2
    if scaled.size and np.abs(scaled).max() > limit:
        raise ValueError(f"components beyond {limit / SCALE:g} give errors that no long can hold")
    return scaled.astype(np.int64)


def _to_blocks(width: int, carried: list[str]):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                piece = batch.slice(start, BLOCK)
                flat = piece.column("vector").flatten().to_numpy(zero_copy_only=False)
                found = integers(flat.reshape(-1, width))
                values, starts, numbers = [], [0], np.empty(found.shape, np.uint16)
                for d in range(width):
                    distinct, numbers[:, d] = np.unique(found[:, d], return_inverse=True)
                    values.append(distinct)
                    starts.append(starts[-1] + len(distinct))
                columns = [
                    pa.ListArray.from_arrays(pa.array([0, piece.num_rows], pa.int32()), piece.column(c)) for c in carried
                ]
                columns += [
                    pa.array([np.concatenate(values)], pa.list_(pa.int64())), pa.array([starts], pa.list_(pa.int32())),
                    pa.array([numbers.tobytes()], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[*carried, *_BLOCKS.names])

    return blocks


def _block(batch: pa.RecordBatch, row: int, width: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The dictionaries of a block and its vectors' numbers in them."""
    values = batch.column("values")[row].values.to_numpy()
    starts = batch.column("starts")[row].values.to_numpy()
    numbers = np.frombuffer(batch.column("numbers")[row].as_py(), np.uint16).reshape(-1, width)
    return [values[a:b] for a, b in zip(starts, starts[1:])], numbers


def _nearest(dictionaries: list[np.ndarray], numbers: np.ndarray, book: np.ndarray) -> Iterator[tuple]:
    """For each part the nearest entry of every vector and its squared distance; ties go to the lower entry."""
    parts, entries, length = book.shape
    rows = np.arange(len(numbers))
    for p in range(parts):
        distance = np.zeros((len(numbers), entries), np.int64)
        for j in range(length):
            d = p * length + j
            table = (dictionaries[d][:, None] - book[p, :, j][None, :]) ** 2
            distance += table[numbers[:, d]]
        best = distance.argmin(axis=1)
        yield best, distance[rows, best]


def _sums(book: np.ndarray):
    """A task's sums of parts by their nearest entry."""
    parts, entries, length = book.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(book.shape, np.int64)
        count = np.zeros((parts, entries), np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                dictionaries, numbers = _block(batch, row, parts * length)
                for p, (best, _) in enumerate(_nearest(dictionaries, numbers, book)):
                    count[p] += np.bincount(best, minlength=entries)
                    for j in range(length):
                        d = p * length + j
                        np.add.at(total[p, :, j], best, dictionaries[d][numbers[:, d]])
        part, entry = np.nonzero(count)
        at = np.repeat(np.arange(len(part)), length)
        place = np.tile(np.arange(length), len(part))
        yield pa.RecordBatch.from_pydict(
            {
                "part": part[at].astype(np.int32), "entry": entry[at].astype(np.int32), "place": place.astype(np.int32),
                "n": count[part[at], entry[at]], "total": total[part[at], entry[at], place],
            }
        )

    return add


def _codes(book: np.ndarray, carried: list[str]):
    parts, _, length = book.shape

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                dictionaries, numbers = _block(batch, row, parts * length)
                best = np.empty((len(numbers), parts), np.uint8)
                error = np.zeros(len(numbers), np.int64)
                for p, (entry, distance) in enumerate(_nearest(dictionaries, numbers, book)):
                    best[:, p] = entry
                    error += distance
                columns = [batch.column(c)[row].values for c in carried]
                columns += [pa.array([b.tobytes() for b in best], pa.binary()), pa.array(error)]
                yield pa.RecordBatch.from_arrays(columns, names=[*carried, "code", "error"])

    return code


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", carry: tuple[str, ...] = (),
    parts: int = 16, entries: int = 64, rounds: int = 2,
) -> Compressed:
    """Codes of all vectors after ``rounds`` rounds of assignment and means; at most 256 entries a part."""
    if not 0 < entries <= 256:
        raise ValueError("a code has one byte a part")
    names = [f"c{i}" for i in range(len(carry))]
    rows = vectors.select(
        F.col(id_col).alias("id"), *[F.col(c).alias(n) for c, n in zip(carry, names)], F.col(vector_col).alias("vector")
    ).where(_whole(F.col("vector")))
    carried = ["id", *names]
    size = F.size("vector")
    order = (F.col("id").asc_nulls_last(), "vector")
    first = rows.where((size > 0) & (size % parts == 0)).orderBy(*order).select(size.alias("n")).first()
    width = first["n"] if first else 0
    fits = rows.where(size == width) if width else rows.where("false")
    begin = [r["vector"] for r in fits.orderBy(*order).limit(entries).select("vector").collect()]
    book = integers(np.array(begin, np.float64).reshape(len(begin), width))
    book = book.reshape(len(begin), parts, width // parts).transpose(1, 0, 2).copy()
    lists = T.StructType([T.StructField(c, T.ArrayType(rows.schema[c].dataType)) for c in carried] + _BLOCKS.fields)
    blocks = settle(fits.mapInArrow(_to_blocks(width, carried), lists), "vector-blocks")
    for _ in range(rounds if width else 0):
        sums = blocks.drop(*carried).mapInArrow(_sums(book), "part int, entry int, place int, n long, total long")
        added = sums.groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
        for r in added.collect():
            book[r["part"], r["entry"], r["place"]] = r["total"] // r["n"]
    coded = T.StructType(
        [rows.schema[c] for c in carried] + [T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())]
    )
    codes = blocks.mapInArrow(_codes(book, carried), coded)
    others = rows.where(size != width).select(
        *carried, F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error")
    )
    found = settle(codes.unionByName(others), "vector-codes")
    return Compressed(found.select("id", *[F.col(n).alias(c) for n, c in zip(names, carry)], "code", "error"), book)


def group_totals(rows: DataFrame, group: str, value: str, name: str) -> DataFrame:
    """The rows with the sum of ``value`` over their group, nulls being a group; a hot group is met in parts."""
    deal = F.pmod(F.xxhash64(*rows.columns), F.lit(partitions(rows.sparkSession)))
    dealt = rows.withColumn("_deal", deal)
    totals = (
        dealt.groupBy(group, "_deal").agg(F.sum(value).alias("_sum"))
        .groupBy(group).agg(F.sum("_sum").alias(name), F.collect_list("_deal").alias("_deals"))
        .select(F.col(group).alias("_group"), name, F.explode("_deals").alias("_met"))
    )
    same = dealt[group].eqNullSafe(totals["_group"]) & (dealt["_deal"] == totals["_met"])
    return dealt.join(totals, same).drop("_deal", "_group", "_met")


def decode(compressed: Compressed) -> DataFrame:
    """(id, vector): the vectors that the codes stand for."""
    book = compressed.codebooks

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [np.frombuffer(c, np.uint8) for c in batch.column("code").to_pylist()]
            found = [book[np.arange(len(c)), c].ravel() / SCALE for c in codes]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(found, pa.list_(pa.float64()))], names=["id", "vector"]
            )

    rows = compressed.codes.where("code IS NOT NULL").select("id", "code")
    shape = T.StructType([rows.schema["id"], T.StructField("vector", T.ArrayType(T.DoubleType()))])
    return rows.mapInArrow(restore, shape)
