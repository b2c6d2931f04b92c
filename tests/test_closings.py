"""Closings as a stream: events over several runs against all sightings, broken runs, late scans."""

import datetime
import random

from vacantia.operators import lifecycle, spanstate
from vacantia.streaming import closings, run

START = datetime.date(2026, 1, 10)
DAYS = 24
LOG = "listing_id string, board string, day date, scan_ok boolean"


def day(n):
    return START + datetime.timedelta(n)


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def make_log():
    rng = random.Random(4)
    rows = []
    for i in range(9):
        board = f"b{i % 2}"
        rows += [(f"x{i}", board, day(d), (d + i) % 8 != 0) for d in range(DAYS) if rng.random() < 0.1 + 0.1 * i]
    return rows + [(None, f"b{b}", day(d), True) for b in range(2) for d in range(DAYS) if (d + b) % 4 == 0]


def land(spark, path, rows):
    spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(path)


def check(spark, path, rows, terms):
    log = spark.createDataFrame(rows, LOG)
    ok = log.where("scan_ok")
    days = ok.select("board", "day").distinct()
    as_of = max(r[2] for r in rows if r[3]).isoformat()
    whole = lifecycle.gaps(lifecycle.sightings(log.where("listing_id IS NOT NULL")), days, as_of, terms)
    left = closings.standing(closings.emitted(spark, path))
    assert rows_of(closings.closed_now(left)) == rows_of(lifecycle.close_absent(whole))
    assert rows_of(closings.returns(left)) == rows_of(lifecycle.reopen(whole))
    first = lifecycle.spans(whole).select("listing_id", "first_seen")
    assert rows_of(left.where("event = 'opened'").select("listing_id", "day")) == rows_of(first)


def test_events_over_days_out_of_order(spark, tmp_path):
    log, path, rows = str(tmp_path / "log"), str(tmp_path / "out"), make_log()
    terms = spark.createDataFrame([("b1", 5)], "board string, grace int")
    order = list(range(DAYS))
    random.Random(1).shuffle(order)
    landed = []
    for k in range(0, DAYS, 8):
        for half in (order[k:k + 4], order[k + 4:k + 8]):
            some = [r for r in rows if (r[2] - START).days in half]
            land(spark, log, some)
            landed += some
        stream = run.read_landed(spark, log, spark.createDataFrame([], LOG).schema, files=1)
        closings.follow(stream, path, str(tmp_path / "progress"), terms)
        check(spark, path, landed, terms)
    assert closings.emitted(spark, path).where("n < 0").count() > 0
    before = rows_of(closings.emitted(spark, path))
    closings.follow(stream, path, str(tmp_path / "progress"), terms)
    # A lost checkpoint hands every batch over again.
    closings.follow(stream, path, str(tmp_path / "other"), terms)
    assert rows_of(closings.emitted(spark, path).where("n <> 0")) == before


def test_a_run_broken_before_its_events(spark, tmp_path):
    path, rows = str(tmp_path / "out"), make_log()
    terms = spark.createDataFrame([], "board string, grace int")
    early, late = ([r for r in rows if (r[2] < day(12)) == side] for side in (True, False))
    spanstate.fold(spark, f"{path}/state", spark.createDataFrame(early, LOG))
    closings.emit(spark, path, terms)
    once = rows_of(closings.emitted(spark, path))
    closings.emit(spark, path, terms)
    assert rows_of(closings.emitted(spark, path)) == once
    # The state moves on twice; the run breaks before it emits; the next one catches up.
    spanstate.fold(spark, f"{path}/state", spark.createDataFrame(late[::2], LOG))
    spanstate.fold(spark, f"{path}/state", spark.createDataFrame(late[1::2], LOG))
    closings.emit(spark, path, terms)
    check(spark, path, rows, terms)
