"""Lifecycle from the stored state: days fed out of order, late rows, reruns, broken runs, what a run reads."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from vacantia.operators import lifecycle, spanstate, versions

START = datetime.date(2026, 1, 20)
DAYS = 30
AS_OF = (START + datetime.timedelta(DAYS)).isoformat()
LOG = "listing_id string, board string, day date, scan_ok boolean"


def day(n):
    return START + datetime.timedelta(n)


def make_log(seed):
    rng = random.Random(seed)
    rows = []
    for i in range(12):
        board, share = f"b{i % 3}", rng.choice([0.1, 0.4, 0.9])
        rows += [(f"x{i}", board, day(d), (d + i % 3) % 7 != 0) for d in range(DAYS) if rng.random() < share]
    return rows + [(None, f"b{b}", day(d), True) for b in range(3) for d in range(DAYS) if (d + b) % 5 == 0]


def frames(spark, rows):
    log = spark.createDataFrame(rows, LOG)
    ok = log.where("scan_ok")
    return lifecycle.sightings(log.where("listing_id IS NOT NULL")), ok.select("board", "day").distinct()


def results(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def compare(spark, path, rows, terms):
    """Every answer from the state equals the one from all sightings."""
    seen, days = frames(spark, rows)
    whole = lifecycle.gaps(seen, days, AS_OF, terms)
    stored = spanstate.lifecycle_rows(spark, path, AS_OF, terms)
    assert results(spanstate.spans(stored)) == results(lifecycle.spans(whole))
    assert results(lifecycle.reopen(stored)) == results(lifecycle.reopen(whole))
    parts, kept = spanstate.read(spark, path)
    assert results(kept) == results(days)
    assert results(spanstate.absence(parts, kept, AS_OF)) == results(lifecycle.absence(seen, days, AS_OF))


def test_days_out_of_order(spark, tmp_path):
    """Thirty landings, one a day, in random order; a day's rows in two files; checked on the way."""
    path, rows = str(tmp_path / "state"), make_log(1)
    terms = spark.createDataFrame([("b0", 3), ("b1", 7)], "board string, grace int")
    order = list(range(DAYS))
    random.Random(2).shuffle(order)
    landed = []
    for k, d in enumerate(order):
        today = [r for r in rows if r[2] == day(d)]
        spanstate.fold(spark, path, spark.createDataFrame(today, LOG))
        landed += today
        if k in (9, DAYS - 1):
            compare(spark, path, landed, terms)
    before = results(spanstate.read(spark, path)[0])
    spanstate.fold(spark, path, spark.createDataFrame(rows[:40], LOG))
    assert results(spanstate.read(spark, path)[0]) == before


def test_a_run_reads_its_day_and_the_partitions_it_can_touch(spark, tmp_path):
    path = str(tmp_path / "segments")
    months = [datetime.date(2025, m, 10) for m in range(1, 13)]
    seen = lambda days: spark.createDataFrame([("a", "b0", d) for d in days], "listing_id string, board string, day date")
    spanstate.fold_sightings(spark, path, seen(months))
    base = versions.current(spark, path)
    assert spanstate.touched(base, [datetime.date(2025, 12, 11)]) == ["2025-12"]
    assert spanstate.touched(base, [datetime.date(2025, 12, 1)]) == ["2025-11", "2025-12"]
    after = spanstate.fold_sightings(spark, path, seen([datetime.date(2025, 12, 11)]))
    assert {p for p in base.runs if after.runs[p] != base.runs[p]} == {"2025-12"}
    files = versions.read(spark, path, spanstate.SEGMENT, after, ["2025-12"]).inputFiles()
    assert files and all("2025-12" in f for f in files)


def test_a_late_day_moves_a_segment_between_partitions(spark, tmp_path):
    path = str(tmp_path / "segments")
    put = lambda *days: spanstate.fold_sightings(
        spark, path, spark.createDataFrame([("a", "b0", d) for d in days], "listing_id string, board string, day date"))
    jan, feb = datetime.date(2026, 1, 31), datetime.date(2026, 2, 2)
    assert sorted(put(jan, feb).runs) == ["2026-01", "2026-02"]
    assert sorted(put(datetime.date(2026, 2, 1)).runs) == ["2026-02"]
    assert results(versions.read(spark, path, spanstate.SEGMENT)) == [("a", "b0", jan, feb)]


def test_changes_name_what_a_late_day_restates(spark, tmp_path):
    path = str(tmp_path / "state")
    terms = spark.createDataFrame([], "board string, grace int")
    log = lambda rows: spark.createDataFrame([(k, "b0", day(d), True) for k, d in rows], LOG)
    spanstate.fold(spark, path, log([("a", 0), ("b", 0), ("b", 9), ("c", 5), ("b", 6)]))
    before = spanstate.spans(spanstate.lifecycle_rows(spark, path, AS_OF, terms)).collect()
    before = spark.createDataFrame(before, "listing_id string, first_seen date, last_seen date, last_reopened date, closed_date date")
    spanstate.fold(spark, path, log([("b", 3), ("new", 9)]))
    after = spanstate.spans(spanstate.lifecycle_rows(spark, path, AS_OF, terms))
    got = {r["listing_id"]: (r["was"], r["is"]) for r in spanstate.changes(before, after).collect()}
    # The scan of day 3 closes "a", which had been closed on day 5; "b" was away until day 6 and is not any more.
    assert set(got) == {"a", "b", "new"} and got["new"][0] is None
    assert got["a"][0]["closed_date"] == day(5) and got["a"][1]["closed_date"] == day(3)
    assert got["b"][0]["last_reopened"] == day(6) and got["b"][1]["last_reopened"] is None


def test_a_broken_run_leaves_the_last_version(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k int, v string"
    one = versions.commit(spark.createDataFrame([(1, "a"), (2, "b")], schema), path, F.col("k"), versions.Version())
    # Written but never named, as if the run had broken there.
    versions.write(spark.createDataFrame([(1, "broken")], schema), path, F.col("k"))
    shape = spark.createDataFrame([], schema).schema
    assert results(versions.read(spark, path, shape)) == [(1, "a"), (2, "b")]
    held = versions.read(spark, path, shape)
    changed = held.where("k = 1").withColumn("v", F.concat("v", F.lit("+")))
    two = versions.commit(changed, path, F.col("k"), one)
    assert results(held) == [(1, "a"), (2, "b")]
    assert results(versions.read(spark, path, shape)) == [(1, "a+"), (2, "b")]
    with pytest.raises(RuntimeError, match="another run"):
        versions.commit(changed, path, F.col("k"), one)
    assert results(versions.read(spark, path, shape, two)) == [(1, "a+"), (2, "b")]
    three = versions.commit(spark.createDataFrame([], schema), path, F.col("k"), two, ["2"])
    assert results(versions.read(spark, path, shape)) == [(1, "a+")]
    # The broken run, the refused one's and the empty one's folders; the first version's rows of 1.
    assert versions.retire(spark, path, keep=1) == 4
    assert results(versions.read(spark, path, shape, three)) == [(1, "a+")]


def test_no_rows(spark, tmp_path):
    path = str(tmp_path / "state")
    spanstate.fold(spark, path, spark.createDataFrame([], LOG))
    terms = spark.createDataFrame([], "board string, grace int")
    assert results(spanstate.spans(spanstate.lifecycle_rows(spark, path, AS_OF, terms))) == []
