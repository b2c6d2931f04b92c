"""Best-fit packing in bulk-synchronous rounds.

Documents are tokenised and cut into pieces of at most a sequence's capacity; only a document's first piece
is shorter. A piece of over half the capacity opens a sequence. Then rounds repeat: pieces that wait and gaps
of open sequences are range-sorted together, largest first; a sweep gives each piece the least gap not yet
taken that holds it (its successor), larger pieces first and equal ones by rank; what a range leaves over
meets the gaps left over in ranges before it, by ranks that follow from the counts of each range; gaps are
updated. Pieces that no gap holds open new sequences, the largest first and only as many as their tokens
need. Each round is written to the shared folder.

The driver sees one row for each range and one for each size up to the capacity, whatever the number of
documents.

Defined results: a null text is empty, which is one piece that holds the end token only; repeated rows are
packed each; other columns are never read.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacantia.llm.common import discard, partitions, settle
from vacantia.session import fixed_table

CAPACITY = 1024
END = 2


def default_vocabulary() -> str:
    """The installed byte-level vocabulary of 50,257 ids, in the form of the ``tokenizers`` library."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@functools.cache
def encoder(path: str) -> Callable[[str], list[int]]:
    """The ids of a text as the ``tokenizers`` file gives them, without special tokens added.

    The file's merges are applied by the library for rank files, which takes a sixth of the time. Tokens that the
    file adds to its vocabulary are found in the text before anything else, as the file has it.
    """
    import public_tokenizers

    with open(path, "rb") as file:
        stated = json.load(file)
    model, splitter = stated["model"], stated["pre_tokenizer"]
    added = {token["content"]: token["id"] for token in stated["added_tokens"]}
    plain = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in stated["added_tokens"])
    if splitter["type"] != "ByteLevel" or splitter["add_prefix_space"] or stated["normalizer"] or not plain:
        raise ValueError(f"{path} is no plain byte-level vocabulary")
    spelled = _bytes_of_letters()
    ranks = {
        bytes(spelled[c] for c in token): rank for token, rank in model["vocab"].items() if token not in added
    }
    known = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)
    whole, ordinary = known.encode, known.encode_ordinary

    def encode(text: str) -> list[int]:
        if any(token in text for token in added):
            return whole(text, allowed_special="all")
        return ordinary(text)

    return encode


def _bytes_of_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones stand for themselves, the
    others are numbered from 256 on."""
    itself = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(itself)]
    return {chr(b): b for b in itself} | {chr(256 + i): b for i, b in enumerate(others)}


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n ids; only the first may be short."""
    first = (n - 1) % capacity + 1
    return [(0, first)] + [(start, capacity) for start in range(first, n, capacity)]


_PIECE = [("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]


def pieces(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END,
    vocabulary: str | None = None, with_ids: bool = False,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of each piece, and its ids if asked for."""
    vocabulary = vocabulary or default_vocabulary()
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType.simpleString()
    fields = _PIECE + ([("ids", pa.list_(pa.int32()))] if with_ids else [])

    def tokenize(batches):
        encode = encoder(vocabulary)
        for batch in batches:
            # A batch of long texts gives many ids; its pieces leave in parts.
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                source, found = [], [[] for _ in fields]
                for row, text in enumerate(part.column("text")):
                    ids = np.array([*encode(text.as_py() or ""), end], "<u4")
                    for piece, (start, length) in enumerate(cut(len(ids), capacity)):
                        own = ids[start : start + length]
                        values = (piece, start, length, zlib.crc32(own.tobytes()), own)
                        source.append(row)
                        for column, value in zip(found, values):
                            column.append(value)
                arrays = [part.column("id").take(pa.array(source, pa.int64()))]
                arrays += [pa.array(c, kind) for c, (_, kind) in zip(found, fields)]
                yield pa.RecordBatch.from_arrays(arrays, ["id"] + [name for name, _ in fields])

    schema = f"id {id_type}, piece int, start long, length long, ids_crc32 long"
    return rows.mapInArrow(tokenize, schema + (", ids array<int>" if with_ids else ""))


def _sweep(batches):
    """Matches within one range of rows sorted by size, largest first, gaps before pieces of their size.

    Open gaps are a stack, whose top is the least; a piece takes the top. A row left over gets its rank
    among its kind, from the bottom of the stack for gaps.
    """
    part = TaskContext.get().partitionId()
    stack: list[int] = []
    sizes, uids, gap_of, mate = [], [], [], []
    kinds, waiting = [], []
    for batch in batches:
        for kind, size, uid in zip(*(batch.column(c).to_pylist() for c in ("kind", "size", "uid"))):
            row = len(uids)
            kinds.append(kind)
            sizes.append(size)
            uids.append(uid)
            mate.append(-1)
            if kind == 0:
                stack.append(row)
            elif stack:
                gap = stack.pop()
                mate[row], mate[gap] = gap, row
            else:
                waiting.append(row)
    rank = [-1] * len(uids)
    for group in (stack, waiting):
        for i, row in enumerate(group):
            rank[row] = i
    # A gap that is taken is told by its piece.
    rows = [r for r in range(len(uids)) if kinds[r] == 1 or mate[r] < 0]
    taken = [mate[r] for r in rows]
    long = lambda values: pa.array(values, pa.int64())
    yield pa.RecordBatch.from_arrays(
        [
            long([part] * len(rows)), pa.array([kinds[r] for r in rows], pa.int32()), long([sizes[r] for r in rows]),
            long([uids[r] for r in rows]), long([rank[r] for r in rows]),
            long([uids[t] if t >= 0 else None for t in taken]), long([sizes[t] if t >= 0 else None for t in taken]),
        ],
        ["part", "kind", "size", "uid", "rank", "bin", "gap"],
    )


_SWEPT = "part long, kind int, size long, uid long, rank long, bin long, gap long"


def _across(counts: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int]]:
    """Which ranks of waiting pieces meet which ranks of gaps left in ranges before theirs.

    counts: (range, gaps left, pieces waiting) in order. Gives (range, first rank, past rank, gap range,
    first gap rank); a later piece takes a gap rank one lower.
    """
    stack: list[list[int]] = []
    plan = []
    for part, gaps, wait in counts:
        at = 0
        while at < wait and stack:
            other, left = stack[-1]
            n = min(left, wait - at)
            plan.append((part, at, at + n, other, left - 1))
            at += n
            if n == left:
                stack.pop()
            else:
                stack[-1][1] = left - n
        if gaps:
            stack.append([part, gaps])
    return plan


def _round(state: DataFrame) -> DataFrame:
    """One sweep over waiting pieces (kind 1) and gaps (kind 0): kind 0 left, 1 waiting, 2 placed."""
    spark = state.sparkSession
    order = [F.desc("size"), F.asc("kind"), F.xxhash64("uid")]
    swept = settle(
        state.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).mapInArrow(_sweep, _SWEPT),
        "sweep",
    )
    counts = sorted(
        (r["part"], r["gaps"], r["wait"])
        for r in swept.where("bin IS NULL").groupBy("part").agg(
            F.count_if(F.col("kind") == 0).alias("gaps"), F.count_if(F.col("kind") == 1).alias("wait")
        ).collect()
    )
    placed = swept.where("bin IS NOT NULL").select(F.lit(2).alias("kind"), "size", "uid", "bin", "gap")
    gaps = swept.where("kind = 0").select(
        F.col("part").alias("gpart"), F.col("rank").alias("grank"), F.col("size").alias("gsize"), F.col("uid").alias("guid")
    )
    wait = swept.where("kind = 1 AND bin IS NULL").select("part", "rank", "size", "uid")
    plan = _across(counts)
    none = F.lit(None).cast("long")
    columns = ["kind", "size", "uid", "bin", "gap"]
    if plan:
        spans = fixed_table(spark, plan, "ppart, low, past, other, top")
        within = (F.col("part") == F.col("ppart")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("past"))
        wait = wait.join(F.broadcast(spans), within, "left").withColumn(
            "to", (F.col("top") - (F.col("rank") - F.col("low"))).cast("long")
        ).withColumn("other", F.col("other").cast("long"))
        # Pieces that no gap is left for stay out of the join; they have no gap's rank to be dealt by.
        met = wait.where("other IS NOT NULL")
        taken = F.col("uid").isNotNull()
        rest = gaps.join(met, (F.col("gpart") == F.col("other")) & (F.col("grank") == F.col("to")), "left").select(
            F.when(taken, 2).otherwise(0).alias("kind"), F.coalesce("size", "gsize").alias("size"),
            F.coalesce("uid", "guid").alias("uid"), F.when(taken, F.col("guid")).alias("bin"),
            F.when(taken, F.col("gsize")).alias("gap"),
        )
        wait = wait.where("other IS NULL")
    else:
        rest = gaps.select(F.lit(0).alias("kind"), F.col("gsize").alias("size"), F.col("guid").alias("uid"), none.alias("bin"), none.alias("gap"))
    rest = rest.unionByName(wait.select(F.lit(1).alias("kind"), "size", "uid", none.alias("bin"), none.alias("gap")).select(columns))
    after = settle(placed.unionByName(rest), "round")
    discard(swept)
    return after


def _to_open(after: DataFrame, capacity: int):
    """A condition for the waiting pieces that open sequences now, and the least piece that still waits.

    At least as many sequences are needed as the tokens beyond all gaps fill, and as the pieces larger
    than every gap fill by themselves. The largest pieces open them.
    """
    gap = F.when(F.col("kind") == 0, F.col("size")).when(F.col("kind") == 2, F.col("gap") - F.col("size"))
    wait, gaps = {}, {}
    for r in after.groupBy((F.col("kind") == 1).alias("waits"), F.when(F.col("kind") == 1, F.col("size")).otherwise(gap).alias("s")).count().collect():
        (wait if r["waits"] else gaps)[r["s"]] = r["count"]
    if not wait:
        return None, 0
    widest = max((s for s in gaps if s), default=0)
    tokens = sum(s * n for s, n in wait.items())
    beyond = tokens - sum(s * n for s, n in gaps.items())
    wide = sum(s * n for s, n in wait.items() if s > widest)
    need = max(0, -(-beyond // capacity), -(-wide // capacity))
    rows, size = 0, 0
    for size in sorted(wait, reverse=True):
        if rows + wait[size] > need:
            break
        rows += wait[size]
    waits = F.col("kind") == 1
    if not need:
        return F.lit(False), min(wait)
    if rows == sum(wait.values()):
        return waits, 0
    opens = waits & (F.col("size") > size)
    if rows < need:
        # Of the next size, a share chosen by hash; one row at least.
        share = max(need - rows, 1)
        opens = waits & ((F.col("size") > size) | ((F.col("size") == size) & (F.pmod(F.xxhash64("uid"), F.lit(wait[size])) < share)))
    return opens, min(wait)


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(uid, bin, offset) for items (uid long, length long of 1 to capacity); bin is an item's uid."""
    none = F.lit(None).cast("long")
    start = items.select(F.col("uid"), F.col("length").alias("size"))
    done = [start.where(F.col("size") > capacity // 2).select("uid", F.col("uid").alias("bin"), F.lit(0).cast("long").alias("offset"))]
    after = start.select(
        F.when(F.col("size") > capacity // 2, 2).otherwise(1).alias("kind"), "size", "uid",
        F.when(F.col("size") > capacity // 2, F.col("uid")).alias("bin"),
        F.when(F.col("size") > capacity // 2, F.lit(capacity)).cast("long").alias("gap"),
    )
    stalled = False
    while True:
        opens, least = _to_open(after, capacity)
        if opens is None:
            break
        if stalled:
            # Hashes chose no row of a size; all of the largest open.
            largest = after.where("kind = 1").agg(F.max("size")).first()[0]
            opens = (F.col("kind") == 1) & (F.col("size") == largest)
        opened = after.where(opens)
        gaps = (
            after.where("kind = 0").select(F.col("uid"), "size")
            .unionByName(after.where("kind = 2").select(F.col("bin").alias("uid"), (F.col("gap") - F.col("size")).alias("size")))
            .unionByName(opened.select("uid", (F.lit(capacity) - F.col("size")).alias("size")))
            .where(F.col("size") >= max(1, least))
        )
        waiting = after.where((F.col("kind") == 1) & ~opens).select("uid", "size")
        done.append(opened.select("uid", F.col("uid").alias("bin"), F.lit(0).cast("long").alias("offset")))
        state = gaps.select(F.lit(0).alias("kind"), "size", "uid").unionByName(waiting.select(F.lit(1).alias("kind"), "size", "uid"))
        now = _round(state)
        placed = now.where("kind = 2").select("uid", "bin", (F.lit(capacity) - F.col("gap")).alias("offset"))
        done.append(placed)
        if not least:
            break
        stalled = now.where("kind = 2").isEmpty() and opened.isEmpty()
        after = now
    return functools.reduce(DataFrame.unionByName, done)


def pack_documents(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END,
    vocabulary: str | None = None, with_ids: bool = False,
) -> DataFrame:
    """Per piece: id, piece, start, length, ids_crc32 (and ids), sequence_id, offset."""
    cut_up = settle(
        pieces(documents, id_col, text_col, capacity, end, vocabulary, with_ids)
        .withColumn("uid", F.monotonically_increasing_id()), "pieces",
    )
    # A full piece is a sequence; the others are packed.
    rest = pack(cut_up.where(F.col("length") < capacity).select("uid", "length"), capacity)
    full = cut_up.where(F.col("length") == capacity).withColumn("sequence_id", F.col("uid")).withColumn("offset", F.lit(0).cast("long"))
    packed = cut_up.where(F.col("length") < capacity).join(rest.withColumnRenamed("bin", "sequence_id"), "uid")
    return full.unionByName(packed.select(full.columns)).drop("uid")
