"""Openings, closings and returns as they happen, from landed scans, without reading earlier sightings.

Each batch is folded into the stored segments (``operators.spanstate``); what the state says after it is compared with
what it said when events were last emitted, and the difference is written: ``n`` is 1 for an event that has
happened and -1 for one that a late row takes back. A closing is an event of the board's first successful scan
after the days of grace, so it is emitted by the batch that lands that scan, or an earlier one that had been missing.

Events are named after the versions of the state they lead up to. A run that breaks between the state's commit and its
events finds the state ahead of the events and emits what is missing; one that breaks earlier is run again
on the old state. Nothing is emitted twice and nothing is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vacantia.operators import spanstate, versions
from vacantia.streaming import run

EVENT = T.StructType(
    [
        T.StructField("listing_id", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("day", T.DateType()),
        T.StructField("n", T.LongType()),
    ]
)


def events(gap_rows: DataFrame) -> DataFrame:
    """(listing_id, event, day): the opening of each listing, every closing and every return."""
    opened = gap_rows.groupBy("listing_id").agg(F.min("first").alias("day")).select(
        "listing_id", F.lit("opened").alias("event"), "day"
    )
    back = F.when(F.col("closed_on").isNotNull(), F.col("next_day"))
    turns = gap_rows.select(
        "listing_id",
        F.explode(F.array(
            F.struct(F.lit("closed").alias("event"), F.col("closed_on").alias("day")),
            F.struct(F.lit("reopened").alias("event"), back.alias("day")),
        )).alias("e"),
    ).where("e.day IS NOT NULL")
    return opened.unionByName(turns.select("listing_id", "e.event", "e.day"))


def _state(spark: SparkSession, path: str, segments: int, scan_days: int, grace: DataFrame) -> DataFrame | None:
    """The events of a version of the state; none for a state that was never written."""
    if segments < 0 or scan_days < 0:
        return None
    parts = versions.read(
        spark, f"{path}/segments", spanstate.SEGMENT, versions.at(spark, f"{path}/segments", segments)
    )
    days = versions.read(
        spark, f"{path}/scan_days", spanstate.SCAN_DAY, versions.at(spark, f"{path}/scan_days", scan_days)
    )
    # Nothing landed lies after the last scan day, so the state is judged as of that day.
    last = days.agg(F.max("day")).first()[0]
    return events(spanstate.gaps(parts, days, last.isoformat(), grace)) if last else None


def _emitted(spark: SparkSession, path: str) -> tuple[int, int]:
    """The versions of segments and scan days that the last events lead up to."""
    names = [n for n in versions.names(spark, path) if n.startswith("upto=")]
    done = [n for n in names if "_SUCCESS" in versions.names(spark, f"{path}/{n}")]
    return max((tuple(map(int, n.split("=")[1].split("-"))) for n in done), default=(-1, -1))


def emit(spark: SparkSession, path: str, grace: DataFrame) -> None:
    """Writes the events between the last emitted and the current version of the state in ``path``."""
    was = _emitted(spark, f"{path}/events")
    now = tuple(versions.current(spark, f"{path}/state/{t}").number for t in ("segments", "scan_days"))
    if now == was:
        return
    sides = [
        frame.withColumn("n", F.lit(sign)) for sign, version in ((1, now), (-1, was))
        if (frame := _state(spark, f"{path}/state", *version, grace)) is not None
    ]
    both = sides[0] if len(sides) == 1 else sides[0].unionByName(sides[1]) if sides else None
    if both is None:
        both = spark.createDataFrame([], EVENT)
    news = both.groupBy("listing_id", "event", "day").agg(F.sum("n").alias("n")).where("n <> 0")
    news.write.mode("overwrite").parquet(f"{path}/events/upto={now[0]}-{now[1]}")


def follow(scans: DataFrame, path: str, checkpoint: str, grace: DataFrame) -> list[dict]:
    """Folds and emits every batch of a stream of scan rows (listing_id, board, day, scan_ok)."""
    spark = scans.sparkSession

    def each(batch: DataFrame, number: int) -> None:
        held = batch.persist()
        spanstate.fold(spark, f"{path}/state", held)
        held.unpersist()
        emit(spark, path, grace)

    return run.drain(scans, checkpoint, each)


def emitted(spark: SparkSession, path: str) -> DataFrame:
    """All events emitted, with ``upto``, the versions of the state they lead up to."""
    shape = T.StructType([*EVENT.fields, T.StructField("upto", T.StringType())])
    return spark.read.schema(shape).parquet(f"{path}/events")


def standing(emitted_rows: DataFrame) -> DataFrame:
    """The events that were not taken back."""
    left = emitted_rows.groupBy("listing_id", "event", "day").agg(F.sum("n").alias("n")).where("n > 0")
    return left.drop("n")


def closed_now(standing_rows: DataFrame) -> DataFrame:
    """(listing_id, closed_date) of the listings whose last closing no return follows."""
    last = lambda event: F.max(F.when(F.col("event") == event, F.col("day")))
    per = standing_rows.groupBy("listing_id").agg(
        last("closed").alias("closed_date"), last("reopened").alias("back")
    )
    return per.where("closed_date IS NOT NULL AND (back IS NULL OR back <= closed_date)").drop("back")


def returns(standing_rows: DataFrame) -> DataFrame:
    """(listing_id, closed_date, reopened_date): each return with the closing before it."""
    sort = F.sort_array(F.collect_list(F.struct("day", "event")))
    turns = standing_rows.where("event <> 'opened'").groupBy("listing_id").agg(sort.alias("turns"))
    pairs = F.transform(
        F.col("turns"),
        lambda t, i: F.struct(F.get("turns", i - 1)["day"].alias("closed_date"), t.day.alias("reopened_date"), t.event.alias("event")),
    )
    rows = turns.select("listing_id", F.explode(pairs).alias("p")).where("p.event = 'reopened'")
    return rows.select("listing_id", "p.closed_date", "p.reopened_date")
