"""Streams that keep tables up to date, batch by batch.

Each stream reads what has landed since its last run and ends. Its progress is in the checkpoint folder
the caller names, its rows in the table folder, one sub-folder per batch: a batch that is run again after
a failure replaces its own rows. All folders must be in storage that every executor reaches.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_landed(
    spark: SparkSession, path: str, schema: T.StructType, files: int | None = None
) -> DataFrame:
    """Files of a folder, or those a pattern names, as a stream; at most ``files`` of them a batch."""
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.parquet(path)


def drain(
    stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append"
) -> list[dict]:
    """Hands every batch that has landed since the last run to ``each``, then ends; the batches' progress."""
    running = (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return [json.loads(p.json) for p in running.recentProgress]


def table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows that a stream has kept in a folder, with the number of their ``batch``."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(path)


def merge_by_day(
    stream: DataFrame, path: str, checkpoint: str, reduce: Callable[[DataFrame], DataFrame]
) -> None:
    """Writes the distinct rows with a ``day`` that ``reduce`` makes of each batch; rows the table holds already are left out.

    The table is partitioned by day, and only the days a batch names are read, so the cost of a batch does
    not grow with the table. The days come to the driver; there are as many as the calendar has.
    """

    def write(batch: DataFrame, number: int) -> None:
        rows = reduce(batch).persist()
        days = [r["day"] for r in rows.select("day").distinct().collect()]
        new = rows
        if number and days:
            known = table(batch.sparkSession, path, rows.schema).where(
                F.col("day").isin(days) & (F.col("batch") < number)
            )
            new = rows.join(known.select(rows.columns), rows.columns, "left_anti")
        new.write.mode("overwrite").partitionBy("day").parquet(f"{path}/batch={number}")
        rows.unpersist()

    drain(stream, checkpoint, write)
