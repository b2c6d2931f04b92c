"""Registered queries of the operators and the SQL that must agree with them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.llm import (
    decontamination, licenses, linededup, manifest, packing, pages, pii, quality, shards, simhash, suffixes,
    vectorcodes, warc,
)
from vacantia.llm.oracle import MANIFEST, VECTORS, WARC

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


@query("op1_best_fit_packing")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 1024 tokens."""
    return packing.pack_documents(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


@query("op2_simhash")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@query("op3_license_scan")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Words, base phrases and licence labels of every document."""
    return licenses.scan(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")


@query("op4_html_extraction")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return pages.main_text(table(spark, folder, "pages")).select(
        F.col("id").alias("page_id"), "url", "text", F.char_length("text").cast("long").alias("n_chars")
    )


@query("op5_personal_data")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of the base kinds and all spans of every document."""
    found = pii.personal_spans(table(spark, folder, "documents"))
    spelled = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ","
    )
    base = F.filter("spans", lambda s: s.kind.isin(*pii.BASE_KINDS))
    kinds = F.transform("spans", lambda s: s.kind)
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in pii.BASE_KINDS]
    return found.select(
        F.col("id").alias("doc_id"), *counts, F.sha2(spelled(base), 256).alias("base_sha256"),
        spelled(F.col("spans")).alias("spans"),
    )


@query("op6_sharding")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 40 shards of near equal bytes."""
    return shards.assign(table(spark, folder, "documents"), 40).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op7_quality_rules")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Measures and verdict of every document."""
    return quality.judge(table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "removed_words", "base_failed", "kept",
    )


@query("op8_suffix_dedup")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """What repeated passages of 200 bytes leave of every document."""
    size = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s.end - s.start)
    return suffixes.repeats(table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"), "n_bytes", size.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        "kept_sha256",
    )


@query("op9_decontamination")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Every document that leaks a test item, with the item and the aligned passage."""
    found = decontamination.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "item_id", "score", "from_word", "past_word")


@query("op10_line_dedup")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's lines, and which of them go."""
    return linededup.report(table(spark, folder, "documents")).select(
        F.col("id").alias("doc_id"), "n_lines", F.size("removed").cast("long").alias("n_removed"),
        F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed_lines"),
    )


@query("op11_vector_codes", VECTORS)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Code and error of every vector in 16 parts of 64 entries, after two rounds."""
    made = vectorcodes.compress(table(spark, folder, "embeddings"), carry=("label",))
    total = vectorcodes.group_totals(made.codes, "label", "error", "label_error")
    code = F.lower(F.hex("code"))
    return total.select(
        F.col("id").alias("vec_id"), code.alias("code"), "error", "label_error",
        F.lit(made.sha256()).alias("codebooks_sha256"),
    )


@query("op12_warc", WARC)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's record as read back from the archive it was written to."""
    archive = warc.write_archive(table(spark, folder, "pages"))
    return warc.read_records(spark, archive).select(
        F.col("id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"), "record_type", "refers_to",
    )


@query("op13_merkle_manifest", MANIFEST)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Leaf, subroot, root and proof of every document; every fifth is checked with its text lower-cased."""
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0
    made = manifest.build(
        table(spark, folder, "documents"), altered={"text": manifest.lowered(F.col("text"), tampered)}
    )
    return manifest.verify(made, manifest.prove(made)).withColumnRenamed("id", "doc_id")
