"""Incremental ingest of scans, and the tables that follow from it.

Nothing waits for a watermark: a row that lands days late is kept like any other. What the tables say is
read by the operators that batch queries use, so a stream and a batch over the same rows agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from vacantia.operators import lifecycle
from vacantia.streaming import run

SIGHTING = T.StructType(
    [
        T.StructField("listing_id", T.StringType()),
        T.StructField("board", T.StringType()),
        T.StructField("day", T.DateType()),
    ]
)
SCAN_DAY = T.StructType([T.StructField("board", T.StringType()), T.StructField("day", T.DateType())])


def ingest_scans(scans: DataFrame, path: str, checkpoint: str) -> None:
    """Keeps exactly one row per listing and scan day, however often and however late it was read."""
    run.merge_by_day(scans, path, checkpoint, lifecycle.sightings)


def ingest_scan_days(scans: DataFrame, path: str, checkpoint: str) -> None:
    """Keeps one row per board and day of a successful scan."""
    run.merge_by_day(
        scans, path, checkpoint, lambda batch: batch.where("scan_ok").select("board", "day").distinct()
    )


def sightings(spark: SparkSession, path: str) -> DataFrame:
    return run.table(spark, path, SIGHTING).drop("batch")


def scan_days(spark: SparkSession, path: str) -> DataFrame:
    return run.table(spark, path, SCAN_DAY).drop("batch")
