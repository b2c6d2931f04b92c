"""The employer dimension: one row per configured board."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia import schema
from vacantia.dims import PLATFORM_KEYS


def board_key() -> Column:
    """The parts of a board's key in the order its platform defines, joined by ``/``."""
    out, platform, key = None, F.col("platform"), F.col("key")
    for name, parts in PLATFORM_KEYS.items():
        joined = F.concat_ws("/", *[F.try_element_at(key, F.lit(p)) for p in parts])
        out = F.when(platform == name, joined) if out is None else out.when(platform == name, joined)
    return out


def with_board_key(boards: DataFrame) -> DataFrame:
    """Canonical board key and defaults for the options a board leaves out."""
    none = F.array().cast("array<string>")
    return boards.where(F.col("platform").isin(*PLATFORM_KEYS)).withColumns(
        {
            "board_key": board_key(),
            "security_company": F.coalesce("security_company", F.lit(False)),
            "apply_hosts": F.coalesce("apply_hosts", none),
            "search_terms": F.coalesce("search_terms", none),
        }
    )


def read_employers(spark: SparkSession, path: str) -> DataFrame:
    return with_board_key(spark.read.schema(schema.EMPLOYER).json(path))
