"""Fuzzy line dedup by MinHash; DataFrame functions only.

Lines are normalised (lower case, runs of white space as one space, trimmed) and hashed; equal lines are one
line from then on. Two lines are similar if the Jaccard similarity of their runs of eight characters, all of them,
is at least 0.8; a shorter line is one run. Candidates come from signatures: 24 minimum hashes over all
runs, which give eight bands of three. Lines that share a bucket of a band meet in two passes. First each line meets the
bucket's leaders, the least lines of sixteen parts of it, which joins most components. Then all lines of a
bucket that lead no part and are still in different components are paired, in tiles, so no two lines of a
bucket stay apart unless they were compared; only pairs that could not change a component are left out.

Lines that share a bucket get a wide bitmap of their runs. Bits that differ are no more than runs that differ, so a
pair with too many of them is below the similarity, and its texts are not fetched. Lines that the leaders leave
apart from others are told apart by the number of their different runs too. Every other pair is verified by the exact
similarity, and the components of the links keep one line: that of the least document id.

A line that very many documents share is no hot key: the lines that stand in a ``HOT``th of all places, of which there are at
most ``HOT``, meet the places by broadcast.

Defined results: null and empty texts have no lines, and lines without a character beside white space are
never removed; rows that share an id count as one document and keep the same lines, and so do all rows
without an id; within a document the first of equal lines stays; other columns are kept and never read.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacantia.llm.common import components, discard, fresh, laid_out, row_key, settle

SHINGLE = 8
SIMILARITY = 0.8
BANDS = 8
#: Minimum hashes of a band.
ROWS = 3
#: Leaders of a bucket, met before the rest of it.
LEADERS = 16
#: Lines of a bucket that meet those of another such part, or each other, under one join key.
TILE = 256
#: Longs of a line's bitmap.
WORDS = 8
#: Longs of the bitmap of a line that shares a bucket.
WIDE = 32
#: Lines that stand in more than this part of all places are met by broadcast; there are at most as many.
HOT = 10_000

#: Runs that one row holds on the way to a minimum, so that fewer rows are summed.
_TOGETHER = 4
#: Bytes of a character where runs are cut: of one width, so that a run is found without a walk from the start.
_WIDTH = 4
_BITS = ["n", *[f"w{w}" for w in range(WORDS)]]
_WIDE_BITS = ["n", *[f"x{w}" for w in range(WIDE)]]


def normal_lines(text: Column) -> Column:
    """The normalised lines of a text but for spaces at their ends, in order, empty ones too."""
    text = F.coalesce(text, F.lit(""))
    # Most texts hold single spaces only; finding that out costs far less than the pattern. The signs are
    # sought in the text itself, since every mention of a lowered text would lower it again.
    odd = F.lit(False)
    for sign in ("  ", "\t", "\r", "\x0b", "\x0c"):
        odd = odd | F.contains(text, F.lit(sign))
    single = F.when(odd, F.regexp_replace(text, r"[\x20\x09\x0B-\x0D]+", " ")).otherwise(text)
    return F.split(F.lower(single), "\n", -1)


def _count(wide: Column) -> Column:
    """How many runs a line has that is cut, repeats included."""
    return F.greatest((F.octet_length(wide) / _WIDTH).cast("int") - (SHINGLE - 1), F.lit(1))


def _run(wide: Column, at: Column) -> Column:
    """The hash of the run that starts at a character, from 0."""
    return F.xxhash64(F.substring(wide, at * _WIDTH + 1, F.lit(SHINGLE * _WIDTH)))


def runs(line: Column) -> Column:
    """Hashes of all different runs of a line."""
    # The line is encoded once, as the only element of a list; named within the inner function it would be each time.
    wide = F.array(F.encode(line, "UTF-32"))
    each = F.transform(wide, lambda w: F.transform(F.sequence(F.lit(0), _count(w) - 1), lambda at: _run(w, at)))
    return F.array_distinct(F.get(each, F.lit(0)))


def _lines(rows: DataFrame) -> DataFrame:
    """(line, text): every line that holds a character."""
    return (
        rows.select(F.explode(normal_lines(F.col("text"))).alias("text")).select(F.trim("text").alias("text"))
        .where("text <> ''").select(F.xxhash64("text").alias("line"), "text")
    )


def places(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(key, id, lines): the hash of each line of a row in order, null for lines without a character."""
    hashes = F.transform(
        F.transform(normal_lines(F.col("text")), lambda t: F.trim(t)), lambda t: F.when(t != "", F.xxhash64(t))
    )
    return settle(_rows(documents, id_col, text_col).select("key", "id", hashes.alias("lines")), "line-places")


def texts_once(rows: DataFrame) -> DataFrame:
    """(line, text): every different line, made one before it moves."""
    return _lines(rows).groupBy("line").agg(F.min("text").alias("text"))


def _each_run(lines: DataFrame) -> DataFrame:
    """(line, n, x0, x1, ...): the hashes of all runs, repeats included, some to a row, and how many they are.

    Where the last row would go past the end it repeats the last run.
    """
    first = F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(_TOGETHER))).alias("at")
    cut = lines.select("line", F.encode("text", "UTF-32").alias("wide"))
    each = cut.select("line", "wide", _count(F.col("wide")).alias("n")).select("line", "n", "wide", first)
    return each.select("line", "n", *[
        _run(F.col("wide"), F.least(F.col("at") + i, F.col("n") - 1)).alias(f"x{i}") for i in range(_TOGETHER)
    ])


def _least(band: int, row: int) -> Column:
    """The minimum hash of a row of a band.

    Each row orders the runs by other bits of their hashes, and within a row the bands differ by the highest three.
    So the rows of a band choose runs without regard to each other, and those of two bands mostly different ones.
    """
    mask = band << 61 if band < 4 else (band << 61) - (1 << 64)
    seen = [F.shiftleft(f"x{i}", 21 * row).bitwiseXOR(F.lit(mask).cast("long")) for i in range(_TOGETHER)]
    return F.min(F.least(*seen))


def _bitmap(words: int) -> list[Column]:
    """The longs of the bitmap of the hashes x0, x1, ..."""
    none = F.lit(0).cast("long")

    def of(x: Column, w: int) -> Column:
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(63).cast("int"))
        return F.when(F.pmod(F.shiftrightunsigned(x, 6), F.lit(words)) == w, bit).otherwise(none)

    each = [F.col(f"x{i}") for i in range(_TOGETHER)]
    return [F.bit_or(reduce(Column.bitwiseOR, (of(x, w) for x in each))) for w in range(words)]


def bands(lines: DataFrame) -> DataFrame:
    """(line, buckets): the band keys of each line.

    Runs of a line leave the generator one after the other, and no line is in two tasks, so they are summed in place.
    """
    least = [_least(b, r).alias(f"m{b}_{r}") for b in range(BANDS) for r in range(ROWS)]
    buckets = F.array(*[F.xxhash64(F.lit(b), *[f"m{b}_{r}" for r in range(ROWS)]) for b in range(BANDS)])
    return _each_run(lines).groupBy("line").agg(*least).select("line", buckets.alias("buckets"))


def bitmaps(lines: DataFrame) -> DataFrame:
    """(line, n, w0, w1, ...): the number of each line's runs and their bitmap."""
    bits = [bits.alias(f"w{w}") for w, bits in enumerate(_bitmap(WORDS))]
    return _each_run(lines).groupBy("line").agg(F.max("n").alias("n"), *bits)


def signed_texts(rows: DataFrame) -> DataFrame:
    """(line, text, buckets) of each different line; texts are cut into lines and dealt by them once."""
    lines = texts_once(rows)
    return laid_out(lines.join(bands(lines).hint("merge"), "line"), "line", "line-signatures")


def shared_texts(signed: DataFrame, met: DataFrame) -> DataFrame:
    """(line, text) of the lines that share a bucket; texts are read where they lie, only lines move."""
    wanted = met.select("line").distinct().hint("shuffle_hash")
    return signed.select("line", "text").join(wanted, "line", "left_semi")


def signatures(rows: DataFrame) -> DataFrame:
    """(line, buckets, n, w0, w1, ...): the band keys of each different line, the number of its runs, their bitmap."""
    signed = signed_texts(rows)
    return settle(signed.select("line", "buckets").join(bitmaps(signed.select("line", "text")), "line"), "line-bitmaps")


def members(signed: DataFrame) -> DataFrame:
    """(line, bucket): the lines of each bucket that has several."""
    each = signed.select("line", F.explode("buckets").alias("bucket"))
    # Nearly all buckets have one line, so summing before the shuffle would not pay.
    n = F.count(F.lit(1)).over(Window.partitionBy("bucket"))
    return settle(each.withColumn("n", n).where("n > 1").select("line", "bucket"), "line-members")


def leaders(met: DataFrame) -> DataFrame:
    """(bucket, part, leader, n): the least line of each part of a bucket, and how many lines the part has."""
    return settle(
        met.groupBy("bucket", _part(LEADERS)).agg(F.min("line").alias("leader"), F.count(F.lit(1)).alias("n")),
        "line-leaders",
    )


def _part(of: int) -> Column:
    return F.pmod(F.xxhash64("line"), F.lit(of)).alias("part")


def led_pairs(met: DataFrame, led: DataFrame) -> DataFrame:
    """(u, v): each line with the leaders of its buckets."""
    listed = led.groupBy("bucket").agg(F.collect_list("leader").alias("leaders"))
    pairs = met.join(listed, "bucket").select("line", F.explode("leaders").alias("leader"))
    return pairs.where("line <> leader").select(
        F.least("line", "leader").alias("u"), F.greatest("line", "leader").alias("v")
    ).distinct()


def wide_bitmaps(texts: DataFrame) -> DataFrame:
    """(line, n, x0, x1, ...): the number of each line's runs, repeats included, and their wide bitmap."""
    bits = [bits.alias(f"x{w}") for w, bits in enumerate(_bitmap(WIDE))]
    return _each_run(texts).groupBy("line").agg(F.max("n").alias("n"), *bits)


def other_pairs(
    met: DataFrame, led: DataFrame, roots: DataFrame, signed: DataFrame, similarity: float, texts: DataFrame | None = None
) -> DataFrame:
    """(u, v): all lines of a bucket that do not lead in it and have different roots, but for those whose
    bitmaps tell them apart.

    With their texts, the lines that are left to be paired are told apart by the number of their different runs
    and by wide bitmaps too, which only these lines have.
    """
    rest = met.select("bucket", "line", _part(LEADERS)).join(led.where("n > 1"), ["bucket", "part"])
    rest = rest.where("line <> leader").select("bucket", "line")
    tied = rest.join(roots.withColumnRenamed("node", "line"), "line", "left").select(
        "bucket", "line", F.coalesce("root", "line").alias("root")
    )
    tied = settle(tied, "line-rest")
    open_ones = tied.groupBy("bucket").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n")
    ).where("low < high").select("bucket", F.ceil(F.col("n") / TILE).cast("int").alias("tiles"))
    left_apart = settle(tied.join(open_ones, "bucket"), "line-apart")
    signs, bits = None, _BITS
    apart = (F.col("a_line") < F.col("b_line")) & (F.col("a_root") != F.col("b_root"))
    if texts is None:
        signs = signed.select("line", *bits)
        apart = apart & _possible(similarity, bits)
    else:
        own = texts.join(left_apart.select("line").distinct(), "line", "left_semi")
        # The number of different runs takes the place of that of all.
        sizes = own.select("line", F.size(runs(F.col("text"))).alias("n"))
        signs = settle(wide_bitmaps(own).drop("n").join(sizes, "line"), "line-wide")
        bits = _WIDE_BITS
        sizes = F.least("a_n", "b_n") >= similarity * F.greatest("a_n", "b_n") - 1e-6
        apart = apart & sizes & _possible(similarity, bits)
    part = F.pmod(F.xxhash64("line", "bucket"), F.col("tiles")).cast("int").alias("part")
    buckets = F.collect_list("bucket").over(Window.partitionBy("line")).alias("buckets")
    marked = settle(left_apart.join(signs, "line").select("*", part, buckets), "line-tiles")
    # Lines that are apart in several buckets leave the tiles of the least of them, once.
    apart = apart & (F.array_min(F.array_intersect("a_buckets", "b_buckets")) == F.col("bucket"))
    every = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    left = marked.select("bucket", F.col("part").alias("p"), every.alias("q"), *_sided("a", "line", "root", "buckets", *bits))
    right = marked.select("bucket", every.alias("p"), F.col("part").alias("q"), *_sided("b", "line", "root", "buckets", *bits))
    pairs = left.join(right, ["bucket", "p", "q"]).where(apart)
    return pairs.select(F.col("a_line").alias("u"), F.col("b_line").alias("v"))


def _sided(side: str, *columns: str) -> list[Column]:
    return [F.col(c).alias(f"{side}_{c}") for c in columns]


def _possible(similarity: float, bits: list[str]) -> Column:
    """Whether the bitmaps of two lines leave room for the similarity: a bit that differs is a run that differs."""
    differ = reduce(add, (F.bit_count(F.col(f"a_{w}").bitwiseXOR(F.col(f"b_{w}"))) for w in bits[1:]))
    return differ <= (1 - similarity) / (1 + similarity) * (F.col("a_n") + F.col("b_n")) + 1e-6


def possible(pairs: DataFrame, signed: DataFrame, similarity: float) -> DataFrame:
    """The pairs that the bitmaps do not tell apart, wide ones where the lines have them."""
    bits = _WIDE_BITS if _WIDE_BITS[-1] in signed.columns else _BITS
    met = pairs.join(signed.select(F.col("line").alias("u"), *_sided("a", *bits)), "u").join(
        signed.select(F.col("line").alias("v"), *_sided("b", *bits)), "v"
    )
    return met.where(_possible(similarity, bits)).select("u", "v")


def texts_of(rows: DataFrame, met: DataFrame) -> DataFrame:
    """(line, text) of the lines that share a bucket."""
    return settle(texts_once(rows).join(met.select("line").distinct(), "line", "left_semi"), "line-texts")


def similar(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs whose runs have at least the Jaccard similarity."""
    both = pairs.join(texts.select(F.col("line").alias("u"), F.col("text").alias("a")), "u").join(
        texts.select(F.col("line").alias("v"), F.col("text").alias("b")), "v"
    )
    # One-element generators, because the filter would be moved below the projections and cut each text three times.
    cut = both.select("u", "v", _once(runs(F.col("a")).alias("a"), runs(F.col("b")).alias("b")))
    sizes = (F.size("r.a") + F.size("r.b")).alias("n")
    judged = cut.select("u", "v", _once(sizes, F.size(F.array_intersect("r.a", "r.b")).alias("common")))
    return judged.where(F.col("r.common") >= similarity * (F.col("r.n") - F.col("r.common"))).select("u", "v")


def _once(*columns: Column) -> Column:
    """The columns as a struct r that no later step is written into."""
    return F.explode(F.array(F.struct(*columns))).alias("r")


def linked(rows: DataFrame, similarity: float) -> DataFrame:
    """(node, root) of the lines that are similar to another and not the least of their component."""
    signed = signed_texts(rows)
    met = members(signed)
    led = leaders(met)
    texts = settle(shared_texts(signed, met), "line-texts")
    discard(signed)
    marks = settle(wide_bitmaps(texts), "line-bitmaps")
    sure = similar(settle(possible(led_pairs(met, led), marks, similarity), "line-pairs"), texts, similarity)
    roots = settle(components(sure), "line-roots")
    rest = settle(other_pairs(met, led, roots, marks, similarity, texts), "line-other-pairs")
    more = settle(similar(rest, texts, similarity), "line-other-links")
    if more.isEmpty():
        return roots
    return settle(components(roots.toDF("u", "v").unionByName(more)), "line-roots")


def classes(rows: DataFrame, known: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(line, keep_id, keep_line, n) of each line that stands more than once or has a similar line.

    ``known`` are the places of the lines of ``rows``, ``n`` how many of them the line has.
    """
    lines = settle(
        known.select("id", F.explode("lines").alias("line")).where("line IS NOT NULL")
        .groupBy("line").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n")),
        "lines",
    )
    roots = linked(rows, similarity)
    tied = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    grouped = tied.join(lines, F.col("line") == F.col("node")).select("line", "id", "n", "root")
    # Components are of different lines, each with its least id, so this struct is of linked lines only.
    winners = grouped.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "line")).alias("w"))
    similar_ones = grouped.join(winners, "root").select(
        "line", F.col("w.id").alias("keep_id"), F.col("w.line").alias("keep_line"), "n"
    )
    alone = lines.where("n > 1").join(grouped.select("line"), "line", "left_anti").select(
        "line", F.col("id").alias("keep_id"), F.col("line").alias("keep_line"), "n"
    )
    return settle(similar_ones.unionByName(alone), "line-classes")


def _rows(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return documents.select(
        row_key(id_col, text_col).alias("key"), F.col(id_col).alias("id"), F.col(text_col).alias("text")
    )


def _removals(documents: DataFrame, id_col: str, text_col: str, similarity: float) -> tuple[DataFrame, DataFrame]:
    """(key, removed): the numbers, from 0, of the lines that go, for each row key that loses any; and places."""
    known = places(documents, id_col, text_col)
    kept = classes(_rows(documents, id_col, text_col), known, similarity)
    # The first of equal lines within a row is told without a shuffle.
    each = known.select("key", "id", F.posexplode("lines").alias("at", "line"), "lines").where("line IS NOT NULL").select(
        "key", "id", "at", "line", (F.array_position("lines", F.col("line")) == F.col("at") + 1).alias("first")
    )
    stays = F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("line") == F.col("keep_line")) & F.col("first")
    # At most HOT lines can stand in more than a HOTth of all places.
    most = (known.agg(F.sum(F.size(F.array_compact("lines")))).first()[0] or 0) / HOT
    hot, usual = kept.where(F.col("n") > most).drop("n"), kept.where(F.col("n") <= most).drop("n")
    shared = F.broadcast(hot.withColumn("hot", F.lit(True)))
    marked = each.join(shared, "line", "left")
    found = marked.where("hot").drop("hot").unionByName(
        marked.where("hot IS NULL").select(*each.columns).join(usual, "line").select(
            *each.columns, "keep_id", "keep_line"
        ), allowMissingColumns=False,
    )
    gone = found.where(~stays).groupBy("key").agg(F.array_sort(F.collect_set("at")).alias("removed"))
    return gone, known


def report(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """Per row: id, n_lines (with a character), removed (numbers of the lines that go)."""
    gone, known = _removals(documents, id_col, text_col, similarity)
    rows = known.select("key", "id", F.size(F.array_compact("lines")).cast("long").alias("n_lines"))
    return rows.join(gone, "key", "left").select(
        "id", "n_lines", F.coalesce("removed", F.array().cast("array<int>")).alias("removed")
    )


def dedup_lines(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """The documents with all their columns, their texts without the lines that go.

    A document that loses its last line with a character goes with it.
    """
    key, removed = fresh(documents, "row_key"), fresh(documents, "row_removed")
    gone = _removals(documents, id_col, text_col, similarity)[0].select(
        F.col("key").alias(key), F.col("removed").alias(removed)
    )
    met = documents.withColumn(key, row_key(id_col, text_col)).join(gone, key, "left")
    text = F.col(text_col)
    left = F.array_join(
        F.filter(F.split(text, "\n", -1), lambda line, at: ~F.array_contains(F.col(removed), at)), "\n"
    )
    cut = met.withColumn(text_col, F.when(F.col(removed).isNull(), text).otherwise(left))
    # Other white space stays in a text; a removed line is judged by what normalising leaves of it.
    some = F.col(removed).isNull() | F.col(text_col).rlike(r"[^\x20\x09-\x0D]")
    return cut.where(some).select(documents.columns)
