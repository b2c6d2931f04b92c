"""Lifecycle operators against a day-by-day replay in plain Python."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from vacantia.operators import counts, joins, lifecycle, quality, sets

START = datetime.date(2026, 1, 1)
DAYS = 40
AS_OF = (START + datetime.timedelta(days=DAYS - 1)).isoformat()


def day(n):
    return START + datetime.timedelta(days=n)


def random_log(seed):
    """Sightings of six listings on two boards, with days whose scan failed."""
    pick = random.Random(seed)
    ok = {b: {d for d in range(DAYS) if pick.random() < 0.8} for b in ("b0", "b1")}
    log = []
    for i in range(6):
        board = f"b{i % 2}"
        for d in range(DAYS):
            if pick.random() < (0.15 + 0.1 * i):
                log.append((f"x{i}", board, day(d), d in ok[board]))
    return log, ok


def replay(log, ok, grace):
    """Opens, closes and reopens each listing by walking the scans in order."""
    out = {}
    for listing, board in sorted({(r[0], r[1]) for r in log}):
        seen = {(r[2] - START).days for r in log if r[0] == listing and r[3]}
        if not seen:
            continue
        events, is_open, last = [], None, None
        for d in sorted(ok[board]):
            if d in seen:
                if is_open is False:
                    events.append(("reopened", day(d)))
                is_open, last = True, d
            elif is_open and d - last >= grace[board]:
                events.append(("closed", day(d)))
                is_open = False
        out[listing] = events
    return out


@pytest.mark.parametrize("seed", range(4))
def test_closing_and_reopening(spark, seed):
    log, ok = random_log(seed)
    grace = {"b0": 3, "b1": 7}
    rows = spark.createDataFrame(log, "listing_id string, board string, day date, scan_ok boolean")
    scans = spark.createDataFrame(
        [(b, day(d)) for b, ds in ok.items() for d in sorted(ds)], "board string, day date"
    )
    terms = spark.createDataFrame(list(grace.items()), "board string, grace int")
    gaps = lifecycle.gaps(lifecycle.sightings(rows), scans, AS_OF, terms)
    want = replay(log, ok, grace)

    back = lifecycle.reopen(gaps).collect()
    assert sorted((r["listing_id"], r["reopened_date"]) for r in back) == sorted(
        (k, d) for k, events in want.items() for what, d in events if what == "reopened"
    )
    closed = {r["listing_id"]: r["closed_date"] for r in lifecycle.close_absent(gaps).collect()}
    assert closed == {
        k: events[-1][1] for k, events in want.items() if events and events[-1][0] == "closed"
    }
    spans = {r["listing_id"]: r for r in lifecycle.spans(gaps).collect()}
    assert set(spans) == set(want)
    for k, events in want.items():
        returns = [d for what, d in events if what == "reopened"]
        assert spans[k]["last_reopened"] == (returns[-1] if returns else None)


@pytest.mark.parametrize(
    "outcomes, want",
    [
        ("gg", 1), ("gog", None), ("gs", None), ("gsg", 2), ("sss", 2), ("oggo", None), ("g", None),
        ("sg", None), ("sgg", 2), ("ggs", 1), ("sogg", 3),
    ],
)
def test_dead_links(spark, outcomes, want):
    names = {"g": "gone", "s": "soft_gone", "o": "ok"}
    probes = spark.createDataFrame(
        [("x", day(i), names[c]) for i, c in enumerate(outcomes)],
        "listing_id string, probe_date date, outcome string",
    )
    got = [r["closed_date"] for r in lifecycle.close_dead_links(probes).collect()]
    assert got == ([] if want is None else [day(want)])


def test_community_expiry(spark):
    rows = spark.createDataFrame(
        [
            ("a", "community", day(0), None), ("b", "community", day(1), None),
            ("c", "community", day(0), day(5)), ("d", "board", day(0), None),
        ],
        "id string, source string, date_added date, reopened_date date",
    )
    got = lifecycle.expire_community(rows, day(120).isoformat()).collect()
    assert [(r["listing_id"], r["closed_date"]) for r in got] == [("a", day(120))]


def test_resolution_takes_the_earliest_then_the_first_reason(spark):
    rows = spark.createDataFrame([("a",), ("b",), ("c",)], "listing_id string")

    def claim(*pairs):
        return spark.createDataFrame(list(pairs), "listing_id string, closed_date date")

    got = lifecycle.resolve_lifecycle(
        rows,
        {"absent": claim(("a", day(3)), ("b", day(2))), "gone": claim(("a", day(2)), ("b", day(2)))},
    ).collect()
    found = {r["listing_id"]: (r["closed"], r["closed_date"], r["reason"]) for r in got}
    assert found == {"a": (True, day(2), "gone"), "b": (True, day(2), "absent"), "c": (False, None, None)}


def test_latest_and_scan_vs_stored(spark):
    log = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], "listing_id string, ts int, v string"
    )
    got = lifecycle.latest(log, ["ts"]).collect()
    assert sorted((r["listing_id"], r["v"]) for r in got) == [("a", "y"), ("b", "z")]
    scan = spark.createDataFrame([("a",), ("b",)], "id string")
    stored = spark.createDataFrame([("b",), ("c",)], "id string")
    status = {r["id"]: r["status"] for r in joins.scan_vs_stored(scan, stored).collect()}
    assert status == {"a": "new", "b": "kept", "c": "missing"}
    assert [r["id"] for r in sets.new_rows(scan, stored).collect()] == ["a"]


def test_board_health(spark):
    rows = [("b", day(i), 10, 5) for i in range(8)] + [("b", day(8), 4, 1), ("b", day(9), 0, 0)]
    yields = spark.createDataFrame(rows, "board_key string, scan_date date, n int, kept int")
    got = {r["scan_date"]: r["alarm"] for r in quality.board_health(yields).collect()}
    assert (got[day(0)], got[day(7)], got[day(8)], got[day(9)]) == ("no history", "ok", "low", "empty")


def test_yield_and_daily_counts(spark):
    rows = spark.createDataFrame(
        [("b", day(0), True), ("b", day(0), False)], "board_key string, scan_date date, kept boolean"
    )
    assert tuple(counts.board_yield(rows).first())[2:] == (2, 1)
    log = spark.createDataFrame(
        [("a", day(0)), ("a", day(3)), ("b", day(9))], "listing_id string, d date"
    ).select("listing_id", F.col("d").cast("timestamp").alias("ts"))
    got = lifecycle.daily_new(log, day(5).isoformat()).collect()
    assert sorted((r["day"], r["n"]) for r in got) == [(day(0), 1), (day(5), 1)]
