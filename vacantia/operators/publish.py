"""Sinks: board snapshot, published tables, feeds, releases and alerts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.dims import MONTHS, TABLE_RETENTION, TYPES
from vacantia.functions import dates
from vacantia.functions.text import ci, slug
from vacantia.operators import lifecycle, repeats, sorts
from vacantia.operators.prepare import hay
from vacantia.session import fixed_table


def write_board(listings: DataFrame, path: str, as_of: str, fmt: str = "parquet") -> None:
    """Full snapshot, a folder per type and closed flag, rows in display order.

    Range partitioning on the display order ends in the unique id, so one big table is
    written by many tasks instead of one.
    """
    kept = lifecycle.retain_closed(listings, as_of, TABLE_RETENTION)
    keys = [F.col("type"), *sorts.newest_first_keys()]
    ordered = kept.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered.write.mode("overwrite").partitionBy("type", "closed").format(fmt).save(path)


def write_search_table(listings: DataFrame, path: str) -> None:
    """The stored table searches run on: slug and search text worked out once.

    A folder per type, rows of a file close in date, so a view reads one type and skips
    the row groups outside its days. The age is left to the reader, as it changes daily.
    """
    ready = listings.withColumns({"slug": slug(F.col("category")), "hay": hay()})
    keys = ["type", F.desc("date_added"), "id"]
    ordered = ready.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered.write.mode("overwrite").partitionBy("type").parquet(path)


def read_search_table(spark: SparkSession, path: str, as_of: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("age", dates.age_days(F.col("date_added"), as_of))


def feed_rows(new: DataFrame) -> DataFrame:
    """New rows once for the common feed and once for the feed of their type."""
    return new.withColumn("feed", F.explode(F.array(F.lit("all"), F.col("type"))))


def write_feeds(new: DataFrame, path: str) -> None:
    feed_rows(new).write.mode("overwrite").partitionBy("feed").json(path)


def release_batches(new: DataFrame) -> DataFrame:
    """One release per scrape that found rows, with its counts per type.

    The entries of a release stay rows (``release_entries``): a list column would hold a
    whole batch in one task.
    """
    per_type = [F.count_if(F.col("type") == t).alias(t) for t in TYPES]
    return new.groupBy("scan_date").agg(F.count(F.lit(1)).alias("n"), *per_type)


def release_entries(new: DataFrame) -> DataFrame:
    """Rows of each release with the size of their batch."""
    # One row per scan day, so as long as the calendar whatever the data: safe to broadcast.
    sizes = new.groupBy("scan_date").agg(F.count(F.lit(1)).alias("batch_n"))
    return new.join(F.broadcast(sizes), "scan_date")


def alert_batches(new: DataFrame) -> DataFrame:
    """One alert per type and scrape, with its first and last entry in alert order."""
    entry = F.struct("company", "role", "id")
    return new.groupBy("type", "scan_date").agg(
        F.count(F.lit(1)).alias("n"), F.min(entry).alias("first"), F.max(entry).alias("last")
    )


def write_alerts(new: DataFrame, path: str) -> None:
    """Alert entries in order, a folder per type; a big batch spans several files."""
    keys = ["type", "scan_date", "company", "role", "id"]
    ordered = new.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered.write.mode("overwrite").partitionBy("type").json(path)


def _escape(text: Column) -> Column:
    """Text for a cell: markup as entities, a pipe behind a backslash."""
    for char, spelled in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("|", "\\|")):
        text = F.replace(text, F.lit(char), F.lit(spelled))
    return text


def _short(date: Column) -> Column:
    names = F.array(*[F.lit(m) for m in MONTHS])
    return F.concat_ws(" ", F.get(names, F.month(date) - 1), F.dayofmonth(date).cast("string"))


def published_lines(listings: DataFrame) -> DataFrame:
    """Lines of the published tables with the keys that order them.

    Needs prepared listings with ``locations`` and ``is_new``.
    """
    is_open = ~F.col("closed")
    name = F.when(F.col("is_repeat"), F.lit("↳")).otherwise(_escape(F.col("company")))
    title = F.concat(
        F.when(F.col("is_new"), F.lit("🆕 ")).otherwise(F.lit("")),
        _escape(F.col("role")),
        F.when(F.col("clearance"), F.lit(" 🇺🇸")).otherwise(F.lit("")),
        F.lit("<br><sub>"), _escape(F.col("category")), F.lit("</sub>"),
    )
    spots = F.transform("locations", _escape)
    many = F.concat(
        F.lit("<details><summary>**"), F.size("locations").cast("string"),
        F.lit(" locations**</summary>"), F.array_join(spots, "<br>"), F.lit("</details>"),
    )
    place = F.when(F.size("locations") > 1, many).otherwise(
        F.coalesce(F.get(spots, F.lit(0)), F.lit("United States"))
    )
    link = F.concat(F.lit('<a href="'), F.col("url"), F.lit('">Apply</a>'))
    open_row = F.concat_ws(" | ", name, title, link, place, _short(F.col("date_added")))
    closed_row = F.concat_ws(
        " | ", _escape(F.col("company")), _escape(F.col("role")), _short(F.col("closed_date"))
    )
    marked = repeats.published(listings)
    rows = marked.select(
        "type", "closed", F.lit(1).alias("part"),
        F.when(is_open, F.col("date_added")).otherwise(F.col("closed_date")).alias("day"),
        "company", "id",
        F.concat(F.lit("| "), F.when(is_open, open_row).otherwise(closed_row), F.lit(" |")).alias(
            "line"
        ),
    )
    marks = [
        (kind, shut, part, f"<!-- {table}_{edge} {kind} -->")
        for kind in TYPES
        for shut, table in ((False, "TABLE"), (True, "CLOSED"))
        for part, edge in ((0, "START"), (2, "END"))
    ]
    edges = fixed_table(listings.sparkSession, marks, "type, closed, part, line")
    return rows.unionByName(edges, allowMissingColumns=True)


def write_published(listings: DataFrame, path: str) -> None:
    """The published tables as text, in order over the part files of one folder."""
    lines = published_lines(listings).orderBy(
        "type", "closed", "part", F.desc("day"), ci(F.col("company")), "company", "id"
    )
    lines.select("line").write.mode("overwrite").text(path)
