"""Streams and stored state of the lifecycle over the whole event log; their SQL is that of the batch queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from vacantia import schema
from vacantia.functions.dates import iso
from vacantia.operators import lifecycle, spanstate
from vacantia.plans.bindings import EVT_AS_OF, Data
from vacantia.plans.catalog import ORACLES, query
from vacantia.plans.oracle import SCANS, with_
from vacantia.plans.scan_queries import NEW_AS_OF
from vacantia.session import shared_dir
from vacantia.streaming import closings, first, ingest, run


#: Landings that the log is dealt to, so that most of their days come late.
LANDINGS = 3


class _Landed(Data):
    """The same bindings, with the event log read as a stream."""

    def table(self, name):
        if name != "events":
            return super().table(name)
        return run.read_landed(self.spark, f"{self.folder}/events.parquet*", schema.SCAN_EVENT)


class _Dealt(Data):
    """The same bindings, with the event log landed in parts of scattered days and read as a stream, a part a batch."""

    def __init__(self, spark, folder):
        super().__init__(spark, folder)
        self.landed = shared_dir(spark, "landed")
        events = super().table("events").select(*schema.SCAN_EVENT.names)
        for k in range(LANDINGS):
            part = events.where(F.pmod(F.dayofyear("ts"), F.lit(LANDINGS)) == k)
            part.write.parquet(f"{self.landed}/landing={k}")

    def table(self, name):
        if name != "events":
            return super().table(name)
        return run.read_landed(self.spark, self.landed, schema.SCAN_EVENT)


def _kept(d, into, label: str) -> str:
    """Runs one stream over the log; the folder of its table."""
    path = shared_dir(d.spark, label)
    into(_Landed(d.spark, d.folder).scans(), path, shared_dir(d.spark, f"{label}-progress"))
    return path


def _scan_rows(d):
    return d.scans().select("listing_id", "board", "day", "scan_ok")


def _fed(d) -> str:
    """The stored state after a run for each landing; its folder."""
    path = shared_dir(d.spark, "state")
    log = _scan_rows(d)
    for k in range(LANDINGS):
        spanstate.fold(d.spark, path, log.where(F.pmod(F.dayofyear("day"), F.lit(LANDINGS)) == k))
    return path


def _iso(frame, *columns):
    return frame.withColumns({c: iso(F.col(c)) for c in columns})


def _first_news(d) -> str:
    path = shared_dir(d.spark, "first-seen")
    first.emit_first_sightings(_Landed(d.spark, d.folder).scans(), path, shared_dir(d.spark, "first-seen-progress"))
    return path


@query(
    "str1_ingest_scans",
    with_(SCANS) + "SELECT listing_id, board, CAST(day AS VARCHAR) AS day FROM seen",
)
def _(d):
    seen = ingest.sightings(d.spark, _kept(d, ingest.ingest_scans, "sightings"))
    return seen.withColumn("day", iso(F.col("day")))


@query("str2_first_seen_stream", ORACLES["str2_first_seen"])
def _(d):
    """The emitted rows that stand."""
    rows = first.standing(first.news(d.spark, _first_news(d)))
    return rows.withColumn("first_ts", F.col("first_ts").cast("string"))


@query("str3_close_absent_stream", ORACLES["str3_close_absent"])
def _(d):
    """The emitted closings that stand."""
    path = shared_dir(d.spark, "closings")
    log = _scan_rows(_Dealt(d.spark, d.folder))
    closings.follow(log, path, shared_dir(d.spark, "closings-progress"), d.grace())
    return _iso(closings.closed_now(closings.standing(closings.emitted(d.spark, path))), "closed_date")


@query("str10_daily_new_stream", ORACLES["str10_daily_new"])
def _(d):
    counts = shared_dir(d.spark, "daily-new")
    first.keep_daily_counts(d.spark, _first_news(d), counts, shared_dir(d.spark, "daily-new-progress"), NEW_AS_OF)
    return _iso(first.daily_counts(d.spark, counts), "day")


@query("win4_absence_state", ORACLES["win4_absence"])
def _(d):
    parts, days = spanstate.read(d.spark, _fed(d))
    return _iso(spanstate.absence(parts, days, EVT_AS_OF), "last_seen", "last_scan")


@query("win6_spans_state", ORACLES["win6_spans"])
def _(d):
    rows = spanstate.spans(spanstate.lifecycle_rows(d.spark, _fed(d), EVT_AS_OF, d.grace()))
    return _iso(rows, "first_seen", "last_seen", "last_reopened", "closed_date")


@query("str7_reopen_state", ORACLES["str7_reopen"])
def _(d):
    rows = lifecycle.reopen(spanstate.lifecycle_rows(d.spark, _fed(d), EVT_AS_OF, d.grace()))
    return _iso(rows, "closed_date", "reopened_date")
