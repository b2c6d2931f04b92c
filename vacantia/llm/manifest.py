"""Merkle manifest of a dataset, and inclusion proofs by descent through its content-addressed records.

A leaf is the digest of one row. The leaves of a source, in id order, are gathered in runs of 16 until one
digest is left, the source's subroot; subroots, in order of their source, are gathered in the same way into
the root. Every node is kept as a record from its digest to the digests of its children, and nothing else
says where a node lies: a proof is found by following the base-16 digits of a leaf's rank down from the
root. Requests that share a prefix descend as one row, so a level of the descent has a row for each
wanted node, not for each leaf. Children that are not followed are collected on the way and reversed at the end,
which is the order in which a leaf is folded up to the root.

Ranks come from one range sort; a hot source is many ranges. Levels are grouped by (source, rank / 16), so
no group has over 16 rows, and each level is written to the shared folder. The driver sees the number of
leaves of the largest source, the number of sources and the root.

Defined results: a null field is hashed as ``-``; a null source comes first, a null id first in its source;
rows equal in all hashed fields are leaves of their own, next to each other; an empty table has no rows,
records or root; a single leaf is its source's subroot, and a single subroot the root; columns that
are not hashed are never read, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vacantia.llm.common import partitions, settle

#: Children of a node.
FANOUT = 16
#: The bits of a row's place that number it within its partition.
PLACE_BITS = 33
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Manifest:
    """The written parts of a manifest.

    ``leaves``: id, leaf, altered, ord (number of the source), at (rank within it).
    ``records``: tree (``top`` or ``source``), height, digest, children.
    ``subroots``: ord, source, height, digest. ``root`` is null for an empty table, ``height`` that of the top tree.
    """

    leaves: DataFrame
    records: DataFrame
    subroots: DataFrame
    root: str | None
    height: int


def digest(*parts: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of the parts put together."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(column: Column) -> Column:
    """A value with its length in bytes before it, so that no two rows spell alike."""
    text = column.cast("string")
    spelled = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.when(text.isNull(), F.lit("-")).otherwise(spelled)


def leaf_digest(columns: list[Column]) -> Column:
    return digest(*[field(c) for c in columns])


def lowered(text: Column, when: Column) -> Column:
    """The text with A-Z lower-cased where the condition holds."""
    return F.when(F.coalesce(when, F.lit(False)), F.translate(text, UPPER, UPPER.lower())).otherwise(text)


def ranked(rows: DataFrame, keys: list[str], group: str | None, shares: DataFrame | None = None) -> DataFrame:
    """The rows with ``at``, their rank from 0 by ``keys`` within ``group``, the first of the keys.

    Rows are dealt to ranges, equal ones by their place in the input, and written with their place in the range; the
    rows of a group in lower ranges are added to that. ``shares`` has a row for each group, whose columns are
    added; it meets one row for each range of a group, never the rows.
    """
    parts = partitions(rows.sparkSession)
    dealt = (
        rows.withColumn("_deal", F.xxhash64(F.monotonically_increasing_id()))
        .repartitionByRange(parts, *keys, "_deal").sortWithinPartitions(*keys).drop("_deal")
    )
    placed = settle(dealt.withColumn("_place", F.monotonically_increasing_id()), "manifest-ranks")
    on = [group] if group else []
    part = F.shiftright("_place", PLACE_BITS).alias("_part")
    counted = placed.groupBy(*on, part).agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_low"))
    lower = Window.partitionBy(*(on or [F.lit(0)])).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = counted.select(
        *on, "_part", (F.coalesce(F.sum("_n").over(lower), F.lit(0)) - F.col("_low")).alias("_shift")
    )
    if shares is not None:
        shift = shift.join(shares, on)
    met = placed.withColumn("_part", part).join(shift, [*on, "_part"])
    return met.withColumn("at", F.col("_place") + F.col("_shift")).drop("_place", "_part", "_shift")


def _levels(nodes: DataFrame, largest: int, tree: str) -> list[DataFrame]:
    """The nodes of height 1, 2 and so on over ``nodes`` (ord, at, n, digest), n the nodes of that ord.

    A tree that is down to one node has no rows in the levels above.
    """
    levels: list[DataFrame] = []
    below = nodes
    while largest > 1:
        largest = -(-largest // FANOUT)
        child = F.struct(F.col("at"), F.col("digest"))
        gathered = below.where("n > 1").groupBy("ord", F.floor(F.col("at") / FANOUT).alias("up")).agg(
            F.sort_array(F.collect_list(child)).alias("run"), F.first("n").alias("n")
        )
        children = F.transform("run", lambda c: c.digest)
        below = settle(
            gathered.select(
                "ord", F.col("up").alias("at"), F.ceil(F.col("n") / FANOUT).alias("n"),
                digest(F.array_join(children, "")).alias("digest"), children.alias("children"),
            ),
            f"manifest-{tree}-{len(levels) + 1}",
        )
        levels.append(below)
    return levels


def _tops(nodes: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(ord, height, digest) of each tree's last node."""
    found = nodes.where("n = 1").select("ord", F.lit(0).alias("height"), "digest")
    for height, level in enumerate(levels, 1):
        found = found.unionByName(level.where("n = 1").select("ord", F.lit(height).alias("height"), "digest"))
    return found


def build(
    documents: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    altered: dict[str, Column] | None = None,
) -> Manifest:
    """The manifest of a table, hashed over ``fields`` in that order.

    ``altered`` gives other values of some fields; the digest of a row with them is kept beside its leaf,
    to be checked against the proof of the leaf as it was.
    """
    source = F.col(source_col).cast("string")
    other = [(altered or {}).get(c, F.col(c)) for c in fields]
    # A null source sorts before the others, which keep their order by bytes.
    key = F.when(source.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), source))
    rows = settle(
        documents.select(
            key.alias("key"), F.col(id_col).alias("id"), leaf_digest([F.col(c) for c in fields]).alias("leaf"),
            (leaf_digest(other) if altered else F.lit(None).cast("string")).alias("altered"),
        ),
        "manifest-leaves",
    )
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    sources = settle(ranked(sizes, ["key"], None).withColumnRenamed("at", "ord"), "manifest-sources")
    count, largest = sources.agg(F.count(F.lit(1)), F.max("n")).first()
    leaves = settle(
        ranked(rows, ["key", "id", "leaf"], "key", sources).drop("key"), "manifest-leaf-ranks"
    )
    nodes = leaves.select("ord", "at", "n", F.col("leaf").alias("digest"))
    low = _levels(nodes, largest or 0, "source")
    named = F.when(F.col("key") != "-", F.substring("key", 2, 1 << 30)).alias("source")
    subroots = settle(
        _tops(nodes, low).join(sources.select("ord", named), "ord"), "manifest-subroots"
    )
    heads = subroots.select(
        F.lit(0).cast("long").alias("ord"), F.col("ord").alias("at"), F.lit(count).alias("n"), "digest"
    )
    high = _levels(heads, count, "top")
    top = (high[-1] if high else heads).select("digest").first() if count else None
    records = None
    for tree, levels in (("source", low), ("top", high)):
        for height, level in enumerate(levels, 1):
            part = level.select(
                F.lit(tree).alias("tree"), F.lit(height).alias("height"), "digest", "children"
            )
            records = part if records is None else records.unionByName(part)
    if records is None:
        records = documents.sparkSession.createDataFrame(
            [], "tree string, height int, digest string, children array<string>"
        )
    # Content-addressed: equal subtrees are one record.
    kept = settle(records.dropDuplicates(["tree", "height", "digest"]), "manifest-records")
    return Manifest(leaves.drop("n"), kept, subroots, top[0] if top else None, len(high))


def _segment(children: Column, digit: Column) -> Column:
    """The children left and right of the one that is followed, as bytes."""
    left = F.array_join(F.slice(children, F.lit(1), digit.cast("int")), "")
    right = F.array_join(F.slice(children, digit.cast("int") + 2, F.lit(FANOUT)), "")
    return F.struct(F.unhex(left).alias("left"), F.unhex(right).alias("right"))


def _wanted(runs: DataFrame, height: int) -> DataFrame:
    """For each wanted node of a height the digits of its wanted children; ``runs`` are the nodes of height 1."""
    child = F.shiftright("prefix", 4 * (height - 2))
    return runs.groupBy("ord", F.shiftright(child, 4).alias("prefix")).agg(
        F.collect_set(child.bitwiseAND(F.lit(FANOUT - 1).cast("long"))).alias("digits")
    )


def _follow(front: DataFrame, records: DataFrame, wanted: DataFrame) -> DataFrame:
    """One level down: (ord, prefix, digest, subroot, path) of the wanted children."""
    met = front.join(wanted, ["ord", "prefix"]).join(records.select("digest", "children"), "digest")
    return met.withColumn("digit", F.explode("digits")).select(
        "ord", (F.col("prefix") * FANOUT + F.col("digit")).alias("prefix"),
        F.get("children", F.col("digit").cast("int")).alias("digest"), "subroot",
        F.concat("path", F.array(_segment(F.col("children"), F.col("digit")))).alias("path"),
    )


_PATH = "array<struct<left:binary,right:binary>>"


def _subroot_paths(made: Manifest, runs: DataFrame) -> DataFrame:
    """(ord, prefix 0, digest, subroot, path, height) of the wanted sources, the path from the root down."""
    zero = F.lit(0).cast("long")
    asked = runs.select(F.col("ord").alias("prefix")).distinct().select(zero.alias("ord"), "prefix")
    # Written, so that the first joins are by key like the others and not by the constants of one row.
    front = settle(
        made.subroots.sparkSession.range(1).select(
            zero.alias("ord"), zero.alias("prefix"), F.lit(made.root).alias("digest"),
            F.lit(None).cast("string").alias("subroot"), F.array().cast(_PATH).alias("path"),
        ),
        "manifest-root",
    )
    for height in range(made.height, 0, -1):
        records = made.records.where((F.col("tree") == "top") & (F.col("height") == height))
        front = settle(_follow(front, records, _wanted(asked, height + 1)), f"manifest-top-descent-{height}")
    found = front.select(F.col("prefix").alias("ord"), zero.alias("prefix"), "digest", "path")
    return settle(
        found.join(made.subroots.select("ord", "height"), "ord").withColumn("subroot", F.col("digest")),
        "manifest-subroot-paths",
    )


def prove(made: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """Each requested leaf with its subroot and ``path``, the segments from the leaf's level up to the root.

    ``requests`` are rows of ``made.leaves``, by default all. A segment holds the digests left and right of the node
    on the path, as bytes. ``stored`` is the leaf's digest as the descent found it. Requests descend
    together up to the runs of 16 leaves; there a run meets its path once and is parted in the same task.
    """
    asked = made.leaves if requests is None else requests
    shape = ["row.id", "row.leaf", "row.altered", "subroot", "stored", "path"]
    if made.root is None:
        return made.leaves.where("false").select(
            "id", "leaf", "altered", F.lit("").alias("subroot"), F.lit("").alias("stored"),
            F.array().cast(_PATH).alias("path"),
        )
    row = F.struct("at", "id", "leaf", "altered")
    runs = settle(
        asked.groupBy("ord", F.shiftright("at", 4).alias("prefix")).agg(F.collect_list(row).alias("rows")),
        "manifest-requests",
    )
    nodes = runs.select("ord", "prefix")
    begin = _subroot_paths(made, nodes)
    at_height = lambda h: begin.where(F.col("height") == h).drop("height")
    tallest = begin.agg(F.max("height")).first()[0] or 0
    front = at_height(tallest)
    for height in range(tallest, 1, -1):
        records = made.records.where((F.col("tree") == "source") & (F.col("height") == height))
        down = _follow(front, records, _wanted(nodes, height))
        front = settle(down.unionByName(at_height(height - 1)), f"manifest-descent-{height}")
    alone = at_height(0).join(runs, ["ord", "prefix"]).withColumn("row", F.explode("rows")).select(
        *shape[:4], F.col("digest").alias("stored"), F.reverse("path").alias("path")
    )
    if not tallest:
        return alone
    bottom = made.records.where("tree = 'source' AND height = 1").select("digest", "children")
    deep = front.join(bottom, "digest").join(runs, ["ord", "prefix"]).withColumn("row", F.explode("rows"))
    digit = F.col("row.at").bitwiseAND(F.lit(FANOUT - 1).cast("long"))
    found = deep.select(
        *shape[:4], F.get("children", digit.cast("int")).alias("stored"),
        F.concat(F.array(_segment(F.col("children"), digit)), F.reverse("path")).alias("path"),
    )
    return found.unionByName(alone)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the segments of its path lead to."""
    text = lambda b: F.lower(F.hex(b))
    return F.aggregate(path, leaf, lambda node, s: digest(text(s.left), node, text(s.right)))


def siblings_digest(path: Column) -> Column:
    """Digest of all siblings on a path, level by level, left to right."""
    spelled = F.transform(path, lambda s: F.concat(F.lower(F.hex(s.left)), F.lower(F.hex(s.right))))
    return digest(F.array_join(spelled, ""))


def verify(made: Manifest, proofs: DataFrame) -> DataFrame:
    """Each proof with the root its leaf, or its altered leaf, folds to."""
    now = F.coalesce("altered", "leaf")
    return proofs.select(
        "id", F.col("stored").alias("leaf"), "subroot", F.lit(made.root).alias("root"),
        siblings_digest(F.col("path")).alias("proof_sha256"), fold(now, F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
