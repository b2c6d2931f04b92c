"""Distinct counts by merged sketches: spans, coarser keys, late and repeated rows, nothing at all."""

import datetime

from pyspark.sql import functions as F

from vacantia.operators import sketches

DAY = datetime.date(2026, 11, 1)


def _rows(spark):
    """Days of 3,000 of 20,000 names each, overlapping by half."""
    return spark.range(10).select(F.col("id").alias("n")).crossJoin(spark.range(3000)).select(
        F.date_add(F.lit(DAY), F.col("n").cast("int")).alias("on"), F.when(F.col("n") % 2 == 0, "a").otherwise("b").alias("kind"),
        F.concat(F.lit("name"), F.col("n") * 1500 + F.col("id")).alias("name"),
    )


def test_spans_and_coarser_keys_are_within_the_error(spark):
    days = sketches.day_sketches(_rows(spark), "name", "on", ("kind",))
    assert days.count() == 10
    limit = 4 * sketches.standard_error()
    for span in (1, 4, 10):
        during = F.col("day") < F.date_add(F.lit(DAY), span)
        exact = 1500 * (span + 1)
        assert abs(sketches.estimates(days, (), during).first()["estimate"] - exact) <= limit * exact
    for row in sketches.estimates(days, ("kind",)).collect():
        assert abs(row["estimate"] - 15_000) <= limit * 15_000


def test_late_and_repeated_rows_change_a_day_as_if_they_had_been_there(spark):
    rows = _rows(spark)
    early = F.pmod(F.xxhash64("name"), F.lit(3)) > 0
    of = lambda part: sketches.day_sketches(part, "name", "on", ("kind",))
    folded = sketches.fold(sketches.fold(of(rows.where(early)), of(rows.where(~early))), of(rows.where(early)))
    count = lambda s: sorted(map(tuple, sketches.estimates(s, ("kind", "day")).collect()))
    want = {(k, day): n for k, day, n in count(of(rows))}
    got = count(folded)
    assert len(got) == 10
    for kind, day, n in got:
        assert abs(n - want[kind, day]) <= sketches.standard_error() * 3000


def test_nothing(spark):
    none = sketches.day_sketches(_rows(spark).where("false"), "name", "on")
    assert none.count() == 0 and sketches.estimates(none).first()["estimate"] == 0
    nulls = spark.sql("SELECT DATE '2026-11-01' AS on, CAST(NULL AS STRING) AS name")
    assert sketches.estimates(sketches.day_sketches(nulls, "name", "on")).first()["estimate"] == 0
    assert spark.range(1).select(sketches.close_to(F.lit(103), F.lit(100)).alias("x")).first()["x"]
    assert not spark.range(1).select(sketches.close_to(F.lit(130), F.lit(100)).alias("x")).first()["x"]
