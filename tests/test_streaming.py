"""Streams over files that land one after the other, in several runs on one checkpoint."""

import datetime

from pyspark.sql import functions as F

from vacantia.operators import lifecycle
from vacantia.streaming import ingest, run

START = datetime.date(2026, 1, 1)
SCHEMA = "event_id long, listing_id string, board string, day date, hour int, scan_ok boolean"


def day(n):
    return START + datetime.timedelta(days=n)


def land(spark, path, rows):
    """Rows of (listing, day, scan_ok) as one more file of the log."""
    made = [(i, k, "b0", day(n), i % 24, ok) for i, (k, n, ok) in enumerate(rows)]
    spark.createDataFrame(made, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def timed(frame):
    return frame.withColumn("ts", F.col("day").cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("hour")))


#: Files in the order they land: days out of order, repeated rows, a failed scan, days long gone.
FILES = [
    [("a", 20, True)] * 20 + [("b", 20, True)],
    [("a", 20, True), ("a", 21, True), ("c", 21, False)],
    [("late", 1, True), ("a", 2, True), ("b", 3, True), ("d", 10, True)],
    [("a", 21, True), ("b", 29, True), ("c", 30, True)],
]


def run_streams(spark, log, tables):
    stream = timed(run.read_landed(spark, log, spark.read.parquet(log).schema, files=1))
    for name, into in (("seen", ingest.ingest_scans), ("days", ingest.ingest_scan_days)):
        into(stream, f"{tables}/{name}", f"{tables}/{name}-progress")


def results(spark, seen, days):
    none = spark.createDataFrame([], "board string, grace int")
    gaps = lifecycle.gaps(seen, days, day(40).isoformat(), none)
    return [
        sorted(tuple(r) for r in frame.collect())
        for frame in (seen.select("listing_id", "board", "day"), days.select("board", "day"),
                      lifecycle.close_absent(gaps), lifecycle.reopen(gaps))
    ]


def test_streams_equal_batch_over_two_runs(spark, tmp_path):
    log, tables = str(tmp_path / "log"), str(tmp_path / "tables")
    for i, rows in enumerate(FILES):
        land(spark, log, rows)
        if i in (1, 3):
            run_streams(spark, log, tables)
    run_streams(spark, log, tables)
    whole = timed(spark.read.parquet(log))
    want = results(
        spark, lifecycle.sightings(whole), whole.where("scan_ok").select("board", "day").distinct(),
    )
    got = results(
        spark, ingest.sightings(spark, f"{tables}/seen"), ingest.scan_days(spark, f"{tables}/days"),
    )
    assert got == want
    assert ("late", "b0", day(1)) in got[0] and len(got[0]) == 9
    assert ("a", day(29)) in got[2] and ("a", day(10), day(20)) in got[3]


def test_a_batch_run_again_replaces_its_rows(spark, tmp_path):
    log, path = str(tmp_path / "log"), str(tmp_path / "seen")
    for rows in FILES:
        land(spark, log, rows)
    stream = timed(run.read_landed(spark, log, spark.read.parquet(log).schema, files=1))
    ingest.ingest_scans(stream, path, str(tmp_path / "one"))
    once = sorted(map(tuple, ingest.sightings(spark, path).collect()))
    # A lost checkpoint: every batch is handed over again.
    ingest.ingest_scans(stream, path, str(tmp_path / "two"))
    assert sorted(map(tuple, ingest.sightings(spark, path).collect())) == once
