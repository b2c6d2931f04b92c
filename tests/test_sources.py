"""Sources and sinks through real files."""

import datetime
import json

from pyspark.sql import functions as F

from vacantia import schema
from vacantia.operators import prepare, publish, quality
from vacantia.sources import community, employers, listings, postings, probes, published

AS_OF = "2026-11-21"
TODAY = datetime.date(2026, 11, 21)


def test_board_document(spark, tmp_path):
    rows = [
        {"id": "1", "type": "intern", "company": "A", "date_added": "2026-11-20"},
        {"id": "2", "type": "senior", "company": "A", "date_added": "2026-11-20"},
        {"id": "3", "type": "newgrad", "states": ["VA"], "closed": True, "date_added": "bad",
         "closed_date": "2026-11-01"},
    ]
    (tmp_path / "listings.json").write_text(json.dumps({"categories": ["x"], "rows": rows}, indent=1))
    got = listings.read_listings(spark, str(tmp_path)).orderBy("id").collect()
    assert [(r["id"], r["states"], r["closed"], r["new_days"]) for r in got] == [
        ("1", [], False, 7), ("3", ["VA"], True, 7),
    ]
    assert got[0]["date_added"] == datetime.date(2026, 11, 20)
    assert got[1]["date_added"] is None and got[1]["closed_date"] == datetime.date(2026, 11, 1)


def test_employers(spark, tmp_path):
    rows = [
        {"platform": "workday", "name": "A", "key": {"tenant": "a", "board": "X", "instance": "wd5"}},
        {"platform": "lever", "name": "B", "key": {"slug": "b"}, "security_company": True,
         "apply_hosts": ["b.example"]},
        {"platform": "unknown", "name": "C", "key": {"slug": "c"}},
    ]
    (tmp_path / "boards.json").write_text("\n".join(json.dumps(r) for r in rows))
    got = employers.read_employers(spark, str(tmp_path)).orderBy("name").collect()
    assert [(r["board_key"], r["security_company"], r["apply_hosts"]) for r in got] == [
        ("a/wd5/X", False, []), ("b", True, ["b.example"]),
    ]


def test_probes(spark, tmp_path):
    rows = [
        {"listing_id": "1", "probe_ts": "2026-01-01T01:00:00Z", "outcome": "gone"},
        {"listing_id": "1", "probe_ts": "2026-01-01T09:00:00Z", "outcome": "ok"},
    ]
    (tmp_path / "log.json").write_text("\n".join(json.dumps(r) for r in rows))
    got = probes.read_probes(spark, str(tmp_path)).collect()
    assert [(r["probe_date"].isoformat(), r["outcome"]) for r in got] == [("2026-01-01", "ok")]


def test_submissions(spark):
    frame = spark.createDataFrame(
        [
            (1, "### Company\nx", ["approved"]), (2, "### Company\nx", ["valid"]),
            (3, "a <!-- b -->", ["approved"]), (4, "### A\nx\n### A\ny", ["approved"]),
            (5, "1 < 2 and 3 > 2", ["approved"]),
        ],
        "issue_id long, body string, labels array<string>",
    )
    for column in ("company", "title", "location", "url", "category"):
        frame = frame.withColumn(column, F.lit("x"))
    taken, rejected = community.approved_submissions(frame)
    assert sorted(r["posting_id"] for r in taken.collect()) == ["1", "5"]
    assert {r["issue_id"]: r["reason"] for r in rejected.collect()} == {
        2: "not approved", 3: "html in body", 4: "repeated heading",
    }


def test_pruning_keeps_whole_boards(spark):
    rows = spark.createDataFrame(
        [("workday", "a", " cyber analyst"), ("workday", "a", " cook"), ("workday", "b", " ring cook"),
         ("lever", "c", " cook")],
        "platform string, board_key string, hay string",
    )
    dim = spark.createDataFrame(
        [("workday", "b", ["Ring"])], "platform string, board_key string, search_terms array<string>"
    )
    got = postings.prune_by_terms(rows, dim, F.col("hay")).collect()
    assert sorted((r["board_key"], r["hay"]) for r in got) == [
        ("a", " cyber analyst"), ("b", " ring cook"), ("c", " cook"),
    ]


def test_links(spark):
    rows = spark.createDataFrame(
        [
            ("lever", "b", "1", "https://jobs.vendor.example/1"), ("lever", "b", "2", "https://b.example/2"),
            ("lever", "b", "3", "https://evil.example/\\@b.example"), ("lever", "b", "4", "ftp://b.example"),
            ("lever", "b", "5", "https://user@B.example:8443/x"), ("lever", "b", "6", "https://notvendor.example/"),
            ("lever", "b", "7", "https://b.example/x\n"), ("lever", "b", "8", "https://b.example/\u00a0x"),
        ],
        "platform string, board_key string, posting_id string, url string",
    )
    dim = spark.createDataFrame(
        [("lever", "b", ["b.example"])], "platform string, board_key string, apply_hosts array<string>"
    )
    vendors = spark.createDataFrame(
        [("lever", "vendor.example", "https://vendor.example")], "platform string, domain string, job_page string"
    )
    got = prepare.trusted_links(rows, dim, vendors).orderBy("posting_id").collect()
    assert [r["trusted"] for r in got] == [True, True, False, False, True, False, False, False]
    assert got[2]["link"] == "https://vendor.example/b/3"
    safe = prepare.safe_links(rows).orderBy("posting_id").collect()
    assert [r["url"] != "" for r in safe] == [True, True, False, False, True, True, False, False]


def stored(spark, n=400):
    rows = [
        (
            f"{i:04}", ["intern", "newgrad", "earlycareer"][i % 3], f"Co & {'é' if i % 2 else ''}{i % 7}",
            f"Security <Analyst> {i}", "SOC & Detection", ["A, VA", "B, NY"][: i % 3], i % 4 == 0,
            f"https://x.example/{i}", TODAY - datetime.timedelta(days=i % 9), i % 5 == 0,
            TODAY - datetime.timedelta(days=i % 4) if i % 5 == 0 else None,
        )
        for i in range(n)
    ]
    frame = spark.createDataFrame(
        rows,
        "id string, type string, company string, role string, category string, locations array<string>, "
        "clearance boolean, url string, date_added date, closed boolean, closed_date date",
    )
    return frame.withColumns(
        {"location": F.array_join("locations", "; "), "states": F.array().cast("array<string>"),
         "remote": F.lit(False)}
    )


def test_published_round_trip_over_small_splits(spark, tmp_path):
    """Many input splits, so employers and sections carry over from one to the next."""
    board = prepare.prepare(stored(spark), AS_OF).withColumn("is_new", prepare.is_new())
    path = str(tmp_path / "tables")
    publish.write_published(board, path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        read = published.read_published(spark, path, AS_OF).cache()
        assert read.select("file", "split").distinct().count() > 10
        assert quality.reconcile(read, board).collect() == []
        assert read.count() == 400
        got = {r["url"]: r for r in read.where("NOT closed").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    for row in board.where("NOT closed").collect():
        seen = got[row["url"]]
        for column in ("type", "company", "role", "category", "clearance", "date_added"):
            assert seen[column] == row[column], column
        assert seen["marked_new"] == row["is_new"]
        assert seen["locations"] == (row["locations"] or ["United States"])


def test_reconcile_finds_differences(spark):
    from vacantia.operators import repeats

    rows = stored(spark, 60).where("NOT closed")
    marked = repeats.published(rows).cache()
    assert quality.reconcile(marked, rows).collect() == []
    off = marked.where("id <> '0001'").unionByName(marked.where("id = '0002'"))
    off = off.withColumn("is_repeat", F.when(F.col("id") == "0003", ~F.col("is_repeat")).otherwise(F.col("is_repeat")))
    got = {r["issue"]: r["n"] for r in quality.reconcile(off, rows).collect()}
    assert got == {"missing row": 1, "extra row": 1, "repeat marker": 1}


def test_snapshot_and_feeds(spark, tmp_path):
    rows = stored(spark)
    publish.write_board(rows, str(tmp_path / "board"), AS_OF)
    back = spark.read.parquet(str(tmp_path / "board"))
    assert back.count() == 400
    new = rows.where("NOT closed").withColumn("scan_date", F.col("date_added"))
    publish.write_feeds(new, str(tmp_path / "feeds"))
    feeds = spark.read.json(str(tmp_path / "feeds")).groupBy("feed").count().collect()
    per = {r["feed"]: r["count"] for r in feeds}
    assert per["all"] == per["intern"] + per["newgrad"] + per["earlycareer"] == 320
    publish.write_alerts(new, str(tmp_path / "alerts"))
    assert spark.read.json(str(tmp_path / "alerts")).count() == 320
    assert publish.release_batches(new.where("false")).collect() == []


def test_schemas_name_the_listing_columns():
    assert schema.LISTING.fieldNames()[:3] == ["id", "source", "platform"]
