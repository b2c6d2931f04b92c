"""Display orders.

Each ends in the unique id, so the range partitioner can split a hot day or company
over many tasks and the order is total.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacantia.functions.text import ci


def _company() -> list[Column]:
    return [ci(F.col("company")), F.col("company")]


def newest_first_keys() -> list[Column]:
    return [F.col("closed"), F.desc("date_added"), *_company(), F.col("id")]


def newest_first(listings: DataFrame) -> DataFrame:
    """Open before closed, newest day first, then company without regard to case."""
    return listings.orderBy(*newest_first_keys())


def company_a_to_z(listings: DataFrame) -> DataFrame:
    return listings.orderBy(
        ci(F.col("company")), F.desc("date_added"), F.col("company"), F.col("id")
    )


def published_open(listings: DataFrame) -> DataFrame:
    """Open tables: per type, newest day first."""
    return listings.where(~F.col("closed")).orderBy(
        "type", F.desc("date_added"), *_company(), "id"
    )


def published_closed(listings: DataFrame) -> DataFrame:
    """Closed tables: per type, latest closing first."""
    return listings.where("closed").orderBy("type", F.desc("closed_date"), *_company(), "id")


def hiring_order(pivot: DataFrame) -> DataFrame:
    """Student roles first, then all roles, then name."""
    n = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("intern", "newgrad", "earlycareer")}
    students = n["intern"] + n["newgrad"]
    return pivot.orderBy(F.desc(students), F.desc(students + n["earlycareer"]), *_company())


def employer_directory(employers: DataFrame) -> DataFrame:
    """Each employer once per platform, by platform and name."""
    named = employers.select("platform", "name", "security_company").distinct()
    return named.orderBy("platform", ci(F.col("name")), "name")


def first_boards(employers: DataFrame, k: int) -> DataFrame:
    """The first k boards of each platform.

    Each task keeps only its own first k before rows meet (a bounded top-k window), so
    a platform that holds most boards is never gathered whole.
    """
    order = Window.partitionBy("platform").orderBy(ci(F.col("name")), "name", "board_key")
    ranked = employers.withColumn("n", F.row_number().over(order))
    return ranked.where(F.col("n") <= k)
