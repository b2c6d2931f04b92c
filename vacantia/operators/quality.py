"""Checks of the stored table, the published tables and the scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacantia.dims import TYPES
from vacantia.functions.text import ci
from vacantia.functions.urls import SAFE_LINK
from vacantia.operators import repeats


def validate(listings: DataFrame, categories: list[str] | tuple[str, ...]) -> DataFrame:
    """Broken rules as rows (rule, id). ``date_added`` and ``closed_date`` are ISO text."""
    bad_date = (F.col("date_added").isNull()) | (
        F.col("date_added").try_cast("date").isNull()
    ) | (F.col("closed_date").isNotNull() & F.col("closed_date").try_cast("date").isNull())
    rules = {
        "type": ~F.coalesce(F.col("type").isin(*TYPES), F.lit(False)),
        "category": ~F.coalesce(F.col("category").isin(*categories), F.lit(False)),
        "date": bad_date,
        "closed without date": F.col("closed") & F.col("closed_date").isNull(),
        "link": ~F.coalesce(F.col("url").rlike(SAFE_LINK), F.lit(False)),
    }
    broken = F.array(*[F.when(test, F.lit(rule)) for rule, test in rules.items()])
    rows = listings.select(F.explode(F.array_compact(broken)).alias("rule"), "id")
    ids = _repeated(listings, "id").select(F.lit("id").alias("rule"), "id")
    links = _repeated(listings.where("url <> ''"), "url").select(F.lit("duplicate link").alias("rule"), "id")
    return rows.unionByName(ids).unionByName(links)


def _repeated(listings: DataFrame, key: str) -> DataFrame:
    """The lowest id of every value held by more than one row."""
    counted = listings.groupBy(key).agg(
        F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n")
    )
    return counted.where("n > 1").select(F.col("first_id").alias("id"))


def reconcile(published: DataFrame, listings: DataFrame) -> DataFrame:
    """Differences between the published tables and the rows they should hold.

    A row is known by its link when open and by type, employer and title when closed.
    Counts are compared per key, so rows printed twice show up too.
    """
    marked = repeats.published(listings.where(~F.col("closed"))).select(
        "type", "closed", "company", "role", "url", "is_repeat"
    )
    shut = listings.where("closed").select(
        "type", "closed", "company", "role", F.lit("").alias("url"),
        F.lit(None).cast("boolean").alias("is_repeat"),
    )
    parts = ["type", "closed", "company", "role", "url", "is_repeat"]
    printed = published.withColumns(
        {
            "is_repeat": F.when(~F.col("closed"), F.col("is_repeat")),
            "url": F.when(F.col("closed"), F.lit("")).otherwise(F.col("url")),
        }
    ).select(*parts, F.lit(1).alias("side"))
    wanted = marked.unionByName(shut).select(*parts, F.lit(-1).alias("side"))
    key = ["type", "closed", "company", "role", "url"]
    compared = printed.unionByName(wanted).groupBy(*key).agg(
        F.sum("side").alias("balance"),
        F.sum(F.when(F.col("is_repeat"), F.col("side"))).alias("marks"),
    )
    issue = (
        F.when(F.col("balance") > 0, F.lit("extra row"))
        .when(F.col("balance") < 0, F.lit("missing row"))
        .when(F.coalesce("marks", F.lit(0)) != 0, F.lit("repeat marker"))
    )
    return (
        compared.withColumn("issue", issue)
        .where("issue IS NOT NULL")
        .groupBy("issue")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def out_of_order(published: DataFrame) -> DataFrame:
    """Rows printed above their place, per table (type, closed): below an older day, or on one day below an employer
    that sorts after theirs.

    Rows are known by their place (folder, file, split, at), as ``read_published`` gives them. Neighbours
    are compared within an input split, and each split's first row with the last row of those before.
    """
    day = F.when(F.col("closed"), F.col("closed_date")).otherwise(F.col("date_added"))
    place = F.struct(day.alias("day"), ci(F.col("company")).alias("key"), F.col("company").alias("name"))
    rows = published.select("type", "closed", "folder", "file", "split", "at", place.alias("place"))
    table, split = ["type", "closed", "folder"], ["type", "closed", "folder", "file", "split"]
    above = F.lag("place").over(Window.partitionBy(*split).orderBy("at"))
    within = rows.withColumn("above", above).groupBy(*split).agg(
        F.count_if(_belongs_above(F.col("place"), F.col("above"))).alias("n"),
        F.min_by("place", "at").alias("first"), F.max_by("place", "at").alias("last"),
    )
    before = F.lag("last").over(Window.partitionBy(*table).orderBy("file", "split"))
    late = F.coalesce(_belongs_above(F.col("first"), F.col("before")).cast("int"), F.lit(0))
    seams = within.withColumn("before", before).withColumn("seam", late)
    return seams.groupBy("type", "closed").agg(F.sum(F.col("n") + F.col("seam")).alias("n"))


def _belongs_above(row: Column, above: Column) -> Column:
    """Newest day first, then the employer without regard to case and accents, then its spelling."""
    name = (row["key"] < above["key"]) | ((row["key"] == above["key"]) & (row["name"] < above["name"]))
    return (row["day"] > above["day"]) | ((row["day"] == above["day"]) & name)


def board_health(yields: DataFrame, scans: int = 7, floor: float = 0.5) -> DataFrame:
    """Scans that kept nothing, or far less than the board's own recent average.

    The window runs over one row per board and scan day.
    """
    back = Window.partitionBy("board_key").orderBy("scan_date").rowsBetween(-scans, -1)
    usual = F.avg("n").over(back)
    alarm = (
        F.when(F.col("usual").isNull(), F.lit("no history"))
        .when(F.col("n") == 0, F.lit("empty"))
        .when(F.col("n") < floor * F.col("usual"), F.lit("low"))
        .otherwise(F.lit("ok"))
    )
    return yields.withColumn("usual", usual).withColumn("alarm", alarm)
