"""First sightings as a stream that says each thing once.

Every listing has its first sighting as keyed state. A listing not seen before is emitted as ``first``; a sighting that
lands late and lies before it as ``correction``, with the time it takes back. Everything else emits nothing, so the
emitted rows of a day are that day's news. Daily counts are kept from these rows: a correction takes one from
the old day and adds one to the new.

State is held by the state store (RocksDB, on disk, with its changes in the checkpoint folder): one timestamp a listing,
one count a day. There is no watermark, since what it would drop are the corrections. Rows are brought down to one a
listing within each Arrow batch before they are shuffled, so a listing seen very often is no hot key.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from vacantia.streaming import run

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: One emitted row. Times are microseconds since 1970 in the log's own clock while they are in the state.
NEWS = T.StructType(
    [
        T.StructField("listing_id", T.StringType()),
        T.StructField("first_us", T.LongType()),
        T.StructField("was_us", T.LongType()),
    ]
)
_STATE = T.StructType([T.StructField("first_us", T.LongType())])


@contextmanager
def rocksdb(spark: SparkSession):
    """Keyed state on disk for the streams started inside."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


class FirstSighting(StatefulProcessor):
    """The least time of a listing; emits it when it is new or has moved."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._first = handle.getValueState("first", _STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        least = min(r["first_us"] for r in rows)
        held = self._first.get() if self._first.exists() else None
        if held is None or least < held[0]:
            self._first.update((least,))
            yield Row(listing_id=key[0], first_us=least, was_us=held and held[0])

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self._first.update((initialState["first_us"],))

    def close(self) -> None:
        pass


def _least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each listing of a batch."""
    for batch in batches:
        found = pa.Table.from_batches([batch]).group_by("listing_id").aggregate([("first_us", "min")])
        yield from found.rename_columns(["listing_id", "first_us"]).to_batches()


_KEYED = T.StructType(NEWS.fields[:2])


def _micros(column: str):
    """A timestamp without zone as a number, whatever the session's zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(column))


def first_sightings(scans: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """A stream of scan rows (listing_id, ts) as a stream of ``NEWS``.

    ``stored`` (listing_id, first_ts) holds what was known before the stream's first batch; nothing in it is
    emitted again. Later runs on the same checkpoint have their state and leave it unread.
    """
    known = scans.where("listing_id IS NOT NULL AND ts IS NOT NULL").select("listing_id", _micros("ts").alias("first_us"))
    begin = None
    if stored is not None:
        begin = stored.select("listing_id", _micros("first_ts").alias("first_us")).groupBy("listing_id")
    return known.mapInArrow(_least, _KEYED).groupBy("listing_id").transformWithState(
        FirstSighting(), NEWS, "Update", "None", begin
    )


def emit_first_sightings(
    scans: DataFrame, path: str, checkpoint: str, stored: DataFrame | None = None
) -> list[dict]:
    """Writes the news of all that has landed since the last run, a folder a batch; the progress of the batches.

    A batch run again after a failure finds its state as it was before it and replaces its own rows.
    """
    with rocksdb(scans.sparkSession):
        news = first_sightings(scans, stored)
        return run.drain(
            news, checkpoint, lambda batch, n: batch.write.mode("overwrite").parquet(f"{path}/batch={n}"), "update"
        )


def news(spark: SparkSession, path: str) -> DataFrame:
    """The emitted rows: listing_id, first_ts, was_ts (null unless it corrects an earlier row), batch."""
    zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    at = lambda c: F.timestamp_add("MICROSECOND", F.col(c), zero)
    rows = run.table(spark, path, NEWS)
    return rows.select("listing_id", at("first_us").alias("first_ts"), at("was_us").alias("was_ts"), "batch")


def standing(emitted: DataFrame) -> DataFrame:
    """What the emitted rows come to: those that no later one corrects."""
    taken = emitted.where("was_ts IS NOT NULL").select("listing_id", F.col("was_ts").alias("first_ts"))
    return emitted.select("listing_id", "first_ts").join(taken, ["listing_id", "first_ts"], "left_anti")


def keep_daily_counts(
    spark: SparkSession, path: str, counts: str, checkpoint: str, as_of: str
) -> list[dict]:
    """Counts of new listings per UTC day from the news in ``path``, emitted as they change.

    The rows of a batch in ``counts`` are the days whose count has changed and their new counts. Rows dated ahead
    count under the as-of day.
    """
    schema = T.StructType([*NEWS.fields, T.StructField("batch", T.LongType())])
    deltas = (
        run.read_landed(spark, path, schema)
        .select(F.explode(F.array(
            F.struct(F.col("first_us").alias("us"), F.lit(1).alias("n")),
            F.struct(F.col("was_us").alias("us"), F.lit(-1).alias("n")),
        )).alias("d")).where("d.us IS NOT NULL")
    )
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    time = F.least(F.timestamp_add("MICROSECOND", F.col("d.us"), start), F.lit(as_of).cast("date").cast("timestamp_ntz"))
    days = deltas.groupBy(F.window(time, "1 day").alias("w")).agg(F.sum("d.n").alias("n"))
    rows = days.select(F.to_date("w.start").alias("day"), "n")
    with rocksdb(spark):
        return run.drain(
            rows, checkpoint, lambda batch, n: batch.write.mode("overwrite").parquet(f"{counts}/batch={n}"), "update"
        )


_COUNT = T.StructType([T.StructField("day", T.DateType()), T.StructField("n", T.LongType())])


def daily_counts(spark: SparkSession, counts: str) -> DataFrame:
    """The last count of each day."""
    rows = run.table(spark, counts, _COUNT)
    last = rows.groupBy("day").agg(F.max_by("n", "batch").alias("n"))
    return last.where("n <> 0")
