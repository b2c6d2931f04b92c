"""Shards of near equal bytes by histogram sort; DataFrame functions only.

Rows are ordered by a key whose first half is the hash of the text, so equal texts lie together, and whose
second half tells them apart. Exact bytes are counted per key prefix over all partitions; the prefix that
holds a splitter's target is refined by three more hexadecimal digits until a boundary of it is within the
tolerance; then rows are exchanged once. A group of equal texts is cut only if it is larger than the
tolerance and a target lies within it.

A histogram has at most 4096 rows for each splitter, whatever the number of documents.

Defined results: a null text has no bytes; rows equal in text and id share a key and are never parted;
other columns are never read; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vacantia.llm.common import partitions, settle

#: Bytes that a row counts beside its text.
OVERHEAD = 16
#: A splitter may miss its target by this share of a shard.
TOLERANCE = 0.001
DIGITS = 3
KEY = 32


def _hex(column: Column) -> Column:
    return F.lpad(F.hex(column), 16, "0")


def keyed(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return documents.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.concat(_hex(F.xxhash64(text)), _hex(F.xxhash64(F.lit(1), F.col(id_col)))).alias("key"),
    )


def splitters(rows: DataFrame, shards: int, tolerance: float) -> list[str]:
    """Key prefixes at which shard 1, 2, ... begin; a row is in the last shard that begins at or before it.

    A splitter's state is the prefix that holds its target and the exact bytes below that prefix.
    """
    total = rows.agg(F.sum("size")).first()[0] or 0
    if not total:
        return []
    allowed = tolerance * total / shards
    targets = {i: total * i / shards for i in range(1, shards)}
    open_ = {i: ("", 0) for i in targets}
    done: dict[int, str] = {}
    for depth in range(DIGITS, KEY + DIGITS, DIGITS):
        prefixes = sorted({p for p, _ in open_.values()})
        inside = rows if prefixes == [""] else rows.where(F.substring("key", 1, depth - DIGITS).isin(prefixes))
        counted = inside.groupBy(F.substring("key", 1, depth).alias("p")).agg(
            F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")
        )
        histogram = sorted((r["p"], r["bytes"], r["n"]) for r in counted.collect())
        for i, (prefix, below) in list(open_.items()):
            buckets = [b for b in histogram if b[0].startswith(prefix)]
            at, sums = below, []
            for _, size, _ in buckets:
                sums.append(at)
                at += size
            k = bisect_right(sums, targets[i]) - 1
            start, size, n = buckets[k][0], buckets[k][1], buckets[k][2]
            before, after = targets[i] - sums[k], sums[k] + size - targets[i]
            if min(before, after) <= allowed or n == 1 or depth >= KEY:
                # The next bucket's start, or just past this prefix if it is the last one inside.
                past = buckets[k + 1][0] if k + 1 < len(buckets) else start + "g"
                done[i] = start if before <= after else past
                del open_[i]
            else:
                open_[i] = (start, sums[k])
        if not open_:
            break
    return [done[i] for i in sorted(done)]


def assign(
    documents: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", tolerance: float = TOLERANCE,
) -> DataFrame:
    """Per row: id, size, text_crc32, key, shard, slot (gapless from 0 within a shard)."""
    rows = settle(keyed(documents, id_col, text_col), "shard-keys")
    starts = splitters(rows, shards, tolerance)
    shard = F.lit(0)
    for start in starts:
        shard = shard + F.when(F.col("key") >= start, 1).otherwise(0)
    parts = partitions(documents.sparkSession)
    placed = rows.withColumn("shard", shard.cast("int")).withColumn(
        "part", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int")
    )
    # A shard is numbered in parts, so that none of its rows but a part's meet in one task.
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n")).select(
        "shard", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset")
    )
    within = Window.partitionBy("shard", "part").orderBy("key", "id", "size", "text_crc32")
    return (
        placed.withColumn("at", F.row_number().over(within) - 1).join(offsets, ["shard", "part"])
        .select("id", "size", "text_crc32", "key", "shard", (F.col("offset") + F.col("at")).cast("long").alias("slot"))
    )


def write_shards(
    documents: DataFrame, path: str, shards: int, id_col: str = "doc_id", text_col: str = "text",
    tolerance: float = TOLERANCE,
) -> None:
    """Writes the documents with all their columns below ``path``, a folder ``shard=N`` each.

    Rows meet their shard by their key's boundaries alone: one exchange, no join.
    """
    rows = settle(keyed(documents, id_col, text_col).select("key", "size"), "shard-keys")
    starts = splitters(rows, shards, tolerance)
    text = F.coalesce(F.col(text_col), F.lit(""))
    key = F.concat(_hex(F.xxhash64(text)), _hex(F.xxhash64(F.lit(1), F.col(id_col))))
    shard = F.lit(0)
    for start in starts:
        shard = shard + F.when(key >= start, 1).otherwise(0)
    per_shard = max(1, partitions(documents.sparkSession) // shards)
    out = documents.withColumn("shard", shard.cast("int"))
    out.repartition(shards * per_shard, "shard", F.pmod(F.xxhash64(key), F.lit(per_shard))).write.partitionBy(
        "shard"
    ).parquet(path)
