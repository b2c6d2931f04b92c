"""Link checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia import schema


def last_per_day(checks: DataFrame) -> DataFrame:
    """The last check of each listing and day, by a partial aggregate."""
    day = F.to_date("probe_ts").alias("probe_date")
    return checks.groupBy("listing_id", day).agg(
        F.max_by("outcome", F.struct("probe_ts", "outcome")).alias("outcome")
    )


def read_probes(spark: SparkSession, path: str) -> DataFrame:
    return last_per_day(spark.read.schema(schema.PROBE).json(path))
