"""Published tables back to rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vacantia.dims import MONTHS
from vacantia.functions import dates, places
from vacantia.session import stored

_EDGE = r"^<!-- (TABLE|CLOSED)_(START|END) ?([a-z]*) ?-->"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the folder, file and split they come from and their order in the split."""
    lines = spark.read.text(path)
    return lines.select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),
    ).withColumn("folder", F.regexp_replace("file", "/[^/]*$", ""))


#: What a line inherits from the lines above it.
_CARRIED = ["section", "company"]
_SPLIT = ["folder", "file", "split"]


def _fill_within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last value at or above each line of its split.

    A task reads the lines of a split in their order, so this needs neither a sort nor a shuffle.
    """
    last, key = {}, None
    for batch in batches:
        file, split = batch.column("file").to_pylist(), batch.column("split").to_numpy()
        # Batches hold lines of one split or of a few.
        starts = [0, *(i for i in range(1, len(file)) if split[i] != split[i - 1] or file[i] != file[i - 1])]
        columns = {c: [] for c in _CARRIED}
        for start, stop in zip(starts, [*starts[1:], len(file)]):
            if (file[start], split[start]) != key:
                last, key = {}, (file[start], split[start])
            for c in _CARRIED:
                own = batch.column(c).slice(start, stop - start)
                above = pa.array([last.get(c)], own.type)
                filled = pc.fill_null_forward(pa.concat_arrays([above, own])).slice(1)
                last[c] = filled[-1].as_py()
                columns[c].append(filled)
        for c in _CARRIED:
            at = batch.schema.get_field_index(c)
            batch = batch.set_column(at, batch.schema.field(c), pa.concat_arrays(columns[c]))
        yield batch


def _fill_down(lines: DataFrame) -> DataFrame:
    """Last value of each carried column at or above a line, in the order folder, file, split, line.

    What a split inherits from those before it comes from one row for each split: the values at its end.
    """
    filled = stored(lines.mapInArrow(_fill_within, lines.schema), "published-lines")
    ends = filled.groupBy(*_SPLIT).agg(*[F.max_by(c, "at").alias(c) for c in _CARRIED])
    before = Window.partitionBy("folder").orderBy("file", "split").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        *_SPLIT, *[F.last(c, ignorenulls=True).over(before).alias(f"{c}_before") for c in _CARRIED]
    )
    joined = filled.join(carried, _SPLIT)
    return joined.withColumns({c: F.coalesce(c, f"{c}_before") for c in _CARRIED}).drop(
        *[f"{c}_before" for c in _CARRIED]
    )


def _unescape(text: Column) -> Column:
    for entity, char in (("\\|", "|"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def _full_date(short: Column, as_of: str) -> Column:
    """The latest such day not after the as-of day (a day of slack for clock skew)."""
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.substring(short, 1, 3))
    day = F.regexp_extract(short, r"([0-9]+)$", 1).try_cast("int")
    limit = F.date_add(dates.day(as_of), 1)

    def in_year(year: Column) -> Column:
        return F.concat_ws("-", year, month, day).try_cast("date")

    this_year = in_year(F.year(dates.day(as_of)))
    last_year = in_year(F.year(dates.day(as_of)) - 1)
    return F.when(this_year <= limit, this_year).otherwise(last_year)


def read_published(spark: SparkSession, path: str, as_of: str) -> DataFrame:
    """Rows of the open and closed tables; ``↳`` takes the employer of the row above."""
    lines = _lines(spark, path)
    edge = F.regexp_extract("line", _EDGE, 2)
    section = F.when(F.startswith(F.col("line"), F.lit("<!-- ")), F.when(
        edge == "START",
        F.concat_ws(":", F.regexp_extract("line", _EDGE, 1), F.regexp_extract("line", _EDGE, 3)),
    ).when(edge == "END", F.lit("")))
    is_row = (
        F.startswith(F.col("line"), F.lit("| "))
        & ~F.startswith(F.col("line"), F.lit("| Company | Role |"))
        & ~F.startswith(F.col("line"), F.lit("| --"))
    )
    # A name ends at the first bar that is a cell's end; bars within a name are written behind a backslash.
    name = F.trim(F.substring_index(F.substring("line", 3, 1 << 30), " | ", 1))
    marked = lines.select("*", section.alias("section"), F.when(is_row & (name != "↳"), name).alias("company"))
    filled = _fill_down(marked)
    cells = F.split(F.regexp_replace("line", r"^\| | \|$", ""), r" \| ")
    rows = filled.where(is_row & (F.col("section") != "")).withColumn("cells", cells)
    repeated = F.trim(F.get("cells", F.lit(0))) == "↳"
    rows = rows.withColumn("is_repeat", F.coalesce(repeated, F.lit(False)))
    closed = F.startswith(F.col("section"), F.lit("CLOSED"))
    title = F.get("cells", F.lit(1))
    role = F.trim(
        F.regexp_replace(F.regexp_replace(title, "<br><sub>.*$", ""), "^🆕|🇺🇸$", "")
    )
    spots = F.regexp_replace(F.get("cells", F.lit(3)), "<details><summary>.*?</summary>|</details>", "")
    location = F.when(~closed, F.replace(_unescape(spots), F.lit("<br>"), F.lit("; ")))
    last = F.get("cells", F.size("cells") - 1)
    return rows.select(
        F.substring_index("section", ":", -1).alias("type"),
        closed.alias("closed"),
        _unescape(F.col("company")).alias("company"),
        "is_repeat",
        _unescape(F.trim(role)).alias("role"),
        F.when(~closed, _unescape(F.regexp_extract(title, "<sub>(.*)</sub>", 1))).alias("category"),
        F.contains(title, F.lit("🆕")).alias("marked_new"),
        F.contains(title, F.lit("🇺🇸")).alias("clearance"),
        F.when(~closed, F.regexp_extract(F.get("cells", F.lit(2)), 'href="([^"]*)"', 1)).alias("url"),
        location.alias("location"),
        places.location_list(location).alias("locations"),
        F.when(~closed, _full_date(last, as_of)).alias("date_added"),
        F.when(closed, _full_date(last, as_of)).alias("closed_date"),
        "folder", "file", "split", "at",
    )
