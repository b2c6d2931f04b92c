"""Board documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia import schema
from vacantia.dims import NEW_DAYS, TYPES
from vacantia.operators.prepare import with_defaults


def _rows(documents: DataFrame) -> DataFrame:
    """Rows of parsed documents: unknown types dropped, missing values defaulted."""
    row = documents.select(
        F.explode("rows").alias("row"), F.coalesce(F.nullif("new_days", F.lit(0)), F.lit(NEW_DAYS)).alias("new_days")
    ).select("row.*", "new_days")
    days = {c: F.col(c).try_cast("date") for c in ("date_added", "closed_date")}
    return with_defaults(row.where(F.col("type").isin(*TYPES)).withColumns(days))


def read_listings(spark: SparkSession, path: str) -> DataFrame:
    """Listings of all documents under a path, one JSON object per file."""
    return _rows(spark.read.schema(schema.DOCUMENT).json(path, multiLine=True))


def parse_listings(texts: DataFrame, column: str = "document") -> DataFrame:
    """Listings of documents held in a text column."""
    parsed = texts.select(F.from_json(column, schema.DOCUMENT).alias("d")).select("d.*")
    return _rows(parsed)
