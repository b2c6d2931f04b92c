"""First sightings and daily counts as streams: each thing said once, late rows corrected."""

import datetime

from pyspark.sql import functions as F

from vacantia.operators import lifecycle
from vacantia.streaming import first, run

START = datetime.datetime(2026, 1, 1)
SCHEMA = "listing_id string, ts timestamp_ntz"


def at(day, hour=0):
    return START + datetime.timedelta(days=day, hours=hour, microseconds=7)


def land(spark, path, rows):
    spark.createDataFrame([(k, at(*when)) for k, *when in rows], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


FILES = [
    [("a", 20)] * 500 + [("b", 20, 5), ("b", 20, 3)],
    [("a", 21), ("c", 21), ("a", 20, 1)],
    [("late", 1), ("a", 2), ("b", 3), ("d", 90)],
    [("a", 1), ("b", 29), ("c", 30), ("e", 29)],
]


def test_news_over_several_runs(spark, tmp_path):
    log, news, counts = (str(tmp_path / n) for n in ("log", "news", "counts"))
    as_of = "2026-02-01"
    seen, sizes = [], []
    for i, rows in enumerate(FILES):
        land(spark, log, rows)
        seen += rows
        stream = run.read_landed(spark, log, spark.read.parquet(log).schema)
        progress = first.emit_first_sightings(stream, news, str(tmp_path / "p1"))
        sizes += [s["numRowsTotal"] for p in progress for s in p["stateOperators"]][-1:]
        first.keep_daily_counts(spark, news, counts, str(tmp_path / "p2"), as_of)
        whole = spark.createDataFrame([(k, at(*when)) for k, *when in seen], SCHEMA)
        emitted = first.news(spark, news)
        assert rows_of(first.standing(emitted)) == rows_of(lifecycle.first_seen(whole))
        assert rows_of(first.daily_counts(spark, counts)) == rows_of(lifecycle.daily_new(whole, as_of))
    # One state row a listing.
    assert sizes == [2, 3, 5, 6]
    # Every listing once, and once more for each time its first sighting moved.
    per = {r["listing_id"]: r["count"] for r in first.news(spark, news).groupBy("listing_id").count().collect()}
    assert per == {"a": 3, "b": 2, "c": 1, "late": 1, "d": 1, "e": 1}
    before = rows_of(first.news(spark, news))
    first.emit_first_sightings(stream, news, str(tmp_path / "p1"))
    assert rows_of(first.news(spark, news)) == before


def test_what_is_stored_is_not_emitted_again(spark, tmp_path):
    log, news = str(tmp_path / "log"), str(tmp_path / "news")
    land(spark, log, [("a", 5), ("b", 5), ("c", 5)])
    stored = spark.createDataFrame([("a", at(3)), ("b", at(9))], "listing_id string, first_ts timestamp_ntz")
    stream = run.read_landed(spark, log, spark.read.parquet(log).schema)
    first.emit_first_sightings(stream, news, str(tmp_path / "p"), stored)
    got = first.news(spark, news).select("listing_id", "first_ts", "was_ts")
    assert rows_of(got) == [("b", at(5), at(9)), ("c", at(5), None)]
    land(spark, log, [("a", 2), ("b", 9)])
    first.emit_first_sightings(stream, news, str(tmp_path / "p"), stored)
    assert rows_of(first.news(spark, news).where("batch > 0").select("listing_id", "was_ts")) == [("a", at(3))]


def test_rows_without_a_listing_or_time(spark, tmp_path):
    log, news = str(tmp_path / "log"), str(tmp_path / "news")
    rows = spark.createDataFrame([(None, at(1)), ("a", None), ("b", at(1))], SCHEMA)
    rows.coalesce(1).write.parquet(log)
    first.emit_first_sightings(run.read_landed(spark, log, rows.schema), news, str(tmp_path / "p"))
    assert [r["listing_id"] for r in first.news(spark, news).collect()] == ["b"]
