"""WARC archive: records read back against the pages, files by a plain reader, odd rows, damage."""

import base64
import hashlib
import os
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from vacantia.llm import warc

SCHEMA = "page_id long, url string, html string, header string, record string, address string"


@pytest.fixture
def pages(spark):
    return lambda rows: spark.createDataFrame([(*r, "x", None, "y") for r in rows], SCHEMA)


def digest(body):
    return base64.b32encode(hashlib.sha1(body).digest()).decode()


def read(spark, frame):
    return warc.read_records(spark, warc.write_archive(frame)).collect()


def parse(data):
    """The records of a WARC file, read by their lengths alone: (fields, block)."""
    found = []
    while data:
        head, rest = data.split(b"\r\n\r\n", 1)
        version, *lines = head.decode().split("\r\n")
        assert version == "WARC/1.1"
        fields = dict(line.split(": ", 1) for line in lines)
        size = int(fields["Content-Length"])
        assert rest[size:size + 4] == b"\r\n\r\n"
        found.append((fields, rest[:size]))
        data = rest[size + 4:]
    return found


ROWS = [
    (1, "http://a/1", "one"), (2, "http://a/2", "one"), (3, None, "two\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"),
    (4, "http://a/ü", ""), (5, "http://a/5", None), (6, "x\r\nWARC-Type: revisit", "é" * 70_000), (7, "", "one"),
]


def test_each_payload_has_one_response(spark, pages):
    rows = {r["id"]: r for r in read(spark, pages(ROWS))}
    groups = defaultdict(list)
    for i, _, body in ROWS:
        groups[body or ""].append(i)
    for i, url, body in ROWS:
        last = max(groups[body or ""])
        r, data = rows[i], (body or "").encode()
        assert (bytes(r["payload"]), r["digest"]) == (data, digest(data))
        assert (r["record_type"], r["refers_to"]) == (("response", None) if i == last else ("revisit", last))
        assert r["url"] == (url and url.replace("\r", "%0D").replace("\n", "%0A"))


def test_repeated_rows_and_null_ids(spark, pages):
    rows = read(spark, pages([(1, "u", "same")] * 3 + [(None, "u", "same"), (None, "u", "own"), (None, "v", "own")]))
    kinds = Counter((r["id"], r["record_type"], r["refers_to"]) for r in rows)
    assert kinds == {(1, "response", None): 1, (1, "revisit", 1): 2, (None, "revisit", 1): 1,
                     (None, "response", None): 1, (None, "revisit", None): 1}


def test_empty(spark, pages):
    assert read(spark, pages([])) == []


def test_a_payload_of_many_records(spark, pages):
    n = 3 * warc.PART_ROWS + 5
    archive = warc.write_archive(pages([(i, f"u{i}", "hot") for i in range(n)] + [(n, "v", "cold")]))
    assert spark.read.parquet(archive.payloads).count() == 2
    assert spark.read.parquet(archive.headers).where("part > 0").count() > warc.PART_ROWS
    rows = warc.read_records(spark, archive).collect()
    assert sorted(r["id"] for r in rows) == list(range(n + 1))
    assert Counter(r["refers_to"] for r in rows) == {n - 1: n - 1, None: 2}


def test_files_are_warc(spark, pages, tmp_path):
    archive = warc.write_archive(pages(ROWS))
    warc.export_files(spark, archive, str(tmp_path / "out"))
    found = []
    for name in sorted(os.listdir(tmp_path / "out")):
        if name.startswith("part-"):
            found += parse((tmp_path / "out" / name).read_bytes())
    assert len(found) == len(ROWS)
    for fields, block in found:
        head, body = block.split(b"\r\n\r\n", 1)
        i = int(fields["WARC-Record-ID"].split(":")[2])
        want = (ROWS[i - 1][2] or "").encode()
        assert fields["WARC-Payload-Digest"] == "sha1:" + digest(want)
        assert body == (want if fields["WARC-Type"] == "response" else b"")
        assert f"Content-Length: {len(want)}".encode() in head
        assert ("WARC-Refers-To" in fields) == (fields["WARC-Type"] == "revisit")


def test_damage_is_found(spark, pages, tmp_path):
    archive = warc.write_archive(pages(ROWS))
    changed = spark.read.parquet(archive.payloads).withColumn("payload", F.concat("payload", F.lit(b"!")))
    changed.write.parquet(str(tmp_path / "changed"))
    with pytest.raises(Exception, match="payload missing or damaged"):
        warc.read_records(spark, warc.Archive(archive.headers, str(tmp_path / "changed"), "bigint")).collect()


def test_text_ids(spark):
    frame = spark.createDataFrame([("a:b", "u", "x"), ("ü >", "u", "x"), (None, "u", "x")], "page_id string, url string, html string")
    rows = {(r["id"], r["record_type"], r["refers_to"]) for r in read(spark, frame)}
    assert rows == {("a:b", "revisit", "ü >"), ("ü >", "response", None), (None, "revisit", "ü >")}
