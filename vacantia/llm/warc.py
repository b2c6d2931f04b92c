"""Content-addressed WARC archive: payloads once by digest, record headers apart, records put together by joins.

Writing: a page's payload is addressed by its SHA-256. Of the records with one address the last by id is the
``response``, the others are ``revisit`` records of it. ``headers`` holds each record's exact header text (the WARC
header and the head of the HTTP message, with the blank lines that end them), ``payloads`` each payload's
bytes once. Reading: headers meet their payload by address; the bytes are hashed again and must
have their address and the digest and length their header states, or the job fails.

A payload that many records share is no hot key: the last record is found by sums over parts, and headers are dealt
to parts of ``PART_ROWS`` records of an address, each of which meets a copy of the payload. Payload bytes move
once to be stored and once to be read.

Defined results: a null body is an empty payload; a null url has no target line, line breaks in a url
are written as %0D and %0A; a null id sorts before all others; repeated rows are records of their own, told apart by
their number, the last number of the largest id being the response; an empty table gives an empty
archive; other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.llm.common import partitions, settle
from vacantia.session import shared_dir

#: Records of one address that meet one copy of its payload.
PART_ROWS = 256
EOL = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Digits of base 32 as Spark's ``conv`` writes them, and as RFC 4648 does.
_PLAIN, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


@dataclass(frozen=True)
class Archive:
    """Folders of an archive.

    ``headers``: record (its number), address, part, header. ``payloads``: address, payload, parts.
    """

    headers: str
    payloads: str
    id_type: str


def base32(hexadecimal: Column) -> Column:
    """Base 32 of a hexadecimal text whose length is a multiple of five: five digits there are four here."""
    def four(i: int) -> Column:
        return F.lpad(F.conv(F.substring(hexadecimal, 5 * i + 1, 5), 16, 32), 4, "0")

    return F.translate(F.concat(*[four(i) for i in range(8)]), _PLAIN, _BASE32)


def payload_digest(payload: Column) -> Column:
    """SHA-1 of the bytes in base 32, as WARC headers state it."""
    return base32(F.sha1(payload))


def _urn(record_id: Column, record: Column) -> Column:
    return F.concat(
        F.lit("<urn:page:"), F.coalesce(F.url_encode(record_id.cast("string")), F.lit("")), F.lit(":"),
        record.cast("string"), F.lit(">"),
    )


def _name(record_id: Column) -> Column:
    """An id as a text that is never null."""
    return F.coalesce(F.concat(F.lit("="), record_id.cast("string")), F.lit(""))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing if the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(EOL)), F.lit(""))


def _one_line(url: Column) -> Column:
    return F.replace(F.replace(url.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))


def _header(date: str) -> Column:
    """Exact header text of a record: id, url, record, size, digest, and ``last``, the response of its address."""
    revisit = F.col("record") != F.col("last.record")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{EOL}Content-Type: text/html; charset=utf-8{EOL}"),
        _line("Content-Length", F.col("size").cast("string")), F.lit(EOL),
    )
    length = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("size"))
    return F.concat(
        F.lit(f"WARC/1.1{EOL}"),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _urn(F.col("id"), F.col("record"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", _one_line(F.col("url"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        _line("WARC-Refers-To", F.when(revisit, _urn(F.col("last.id"), F.col("last.record")))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", length.cast("string")),
        F.lit(EOL), http,
    )


def write_archive(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
    date: str = "2000-01-01T00:00:00Z",
) -> Archive:
    """Writes one record for each row to the shared folder."""
    spark = pages.sparkSession
    body = F.coalesce(F.col(body_col).cast("string"), F.lit("")).cast("binary")
    raw = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), body.alias("payload"))
    raw = raw.withColumn("address", F.sha2("payload", 256))
    records = settle(
        raw.select(
            "id", "url", "address", F.octet_length("payload").alias("size"), payload_digest(F.col("payload")).alias("digest"),
            F.monotonically_increasing_id().alias("record"),
        ),
        "warc-records",
    )
    dealt = records.withColumn("deal", F.pmod(F.xxhash64("record"), F.lit(partitions(spark))))
    last = (
        dealt.groupBy("address", "deal").agg(F.max(F.struct("id", "record")).alias("last"), F.count(F.lit(1)).alias("n"))
        .groupBy("address").agg(F.max("last").alias("last"), F.sum("n").alias("n"), F.collect_list("deal").alias("deals"))
        .withColumn("copies", F.ceil(F.col("n") / PART_ROWS))
    )
    last = settle(last, "warc-addresses")
    met = dealt.join(last.select("address", "last", "copies", F.explode("deals").alias("deal")), ["address", "deal"])
    archive = Archive(
        shared_dir(spark, "warc-headers"), shared_dir(spark, "warc-payloads"), records.schema["id"].dataType.simpleString()
    )
    part = F.pmod(F.xxhash64("record", F.lit(1)), F.col("copies")).alias("part")
    met.select("record", "address", part, _header(date).alias("header")).write.parquet(archive.headers)
    # Rows equal in id and payload are made one before they move, so they are no hot key either.
    single = raw.groupBy("address", _name(F.col("id")).alias("name")).agg(F.first("payload").alias("payload"))
    keys = last.select("address", _name(F.col("last.id")).alias("name"), "copies")
    single.join(keys, ["address", "name"]).drop("name").write.parquet(archive.payloads)
    return archive


def _stated(name: str, pattern: str = "([^\\r]*)") -> Column:
    """What a header line says, null if there is none."""
    found = F.regexp_extract("header", f"\\r\\n{name}: {pattern}\\r\\n", 1)
    return F.when(F.contains(F.col("header"), F.lit(f"{EOL}{name}: ")), found)


def _page(urn: Column, id_type: str) -> Column:
    """The id within a record's name."""
    text = F.regexp_extract(urn, "^<urn:page:([^:]*):", 1)
    return F.when(text != "", F.url_decode(text).cast(id_type))


def read_records(spark: SparkSession, archive: Archive) -> DataFrame:
    """Every record of an archive with its whole payload, checked: id, url, record_type, refers_to, digest, header,
    payload. ``header`` and ``payload`` put together are the bytes of the record as it was fetched."""
    headers = spark.read.parquet(archive.headers)
    payloads = spark.read.parquet(archive.payloads)
    copies = payloads.select(
        "address", "payload", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("part")
    )
    met = headers.join(copies, ["address", "part"], "left")
    names = _stated("WARC-Record-ID")
    digest = payload_digest(F.col("payload"))
    size = F.octet_length("payload").cast("string")
    # The second length is the HTTP message's: that of the payload alone.
    sized = F.regexp_extract("header", "\\r\\n\\r\\nHTTP/(?s:.*)\\r\\nContent-Length: ([0-9]+)\\r\\n\\r\\n$", 1)
    whole = (
        (F.sha2("payload", 256) == F.col("address")) & (F.concat(F.lit("sha1:"), digest) == _stated("WARC-Payload-Digest"))
        & (size == sized)
    )
    wrong = F.raise_error(F.concat(F.lit("payload missing or damaged: "), F.col("address")))
    return met.select(
        _page(names, archive.id_type).alias("id"), _stated("WARC-Target-URI").alias("url"),
        _stated("WARC-Type").alias("record_type"), _page(_stated("WARC-Refers-To"), archive.id_type).alias("refers_to"),
        F.when(F.coalesce(whole, F.lit(False)), digest).otherwise(wrong.cast("string")).alias("digest"),
        F.col("header").cast("binary").alias("header"), "payload",
    )


def export_files(spark: SparkSession, archive: Archive, path: str) -> None:
    """Writes the archive as WARC files: a response with its payload, a revisit without.

    A response has its payload to itself, so the join has no hot key.
    """
    headers = spark.read.parquet(archive.headers)
    payloads = spark.read.parquet(archive.payloads).select("address", "payload")
    answer = _stated("WARC-Type") == "response"
    responses = headers.where(answer).join(payloads, "address").select(
        F.concat("header", F.col("payload").cast("string")).alias("value")
    )
    revisits = headers.where(~answer).select(F.col("header").alias("value"))
    responses.unionByName(revisits).write.option("lineSep", EOL * 2).text(path)
