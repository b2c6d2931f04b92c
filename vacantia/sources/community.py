"""Community submissions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HTML = r"<[!/a-zA-Z]"
HEADING = r"(?m)^### (.+)$"


def judge_submissions(submissions: DataFrame) -> DataFrame:
    """Adds the reason a submission is not taken over; null when it is clean.

    Markup anywhere in the body, or a heading that comes twice, can show the reviewer
    other text than the row stores. The whole body is searched.
    """
    headings = F.regexp_extract_all("body", F.lit(HEADING), F.lit(1))
    reason = (
        F.when(~F.array_contains("labels", "approved"), F.lit("not approved"))
        .when(F.col("body").rlike(HTML), F.lit("html in body"))
        .when(F.size(headings) != F.size(F.array_distinct(headings)), F.lit("repeated heading"))
    )
    return submissions.withColumn("reason", reason)


def approved_submissions(submissions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Postings of clean approved submissions, and the rest with the reason."""
    judged = judge_submissions(submissions)
    taken = judged.where("reason IS NULL").select(
        F.lit("community").alias("platform"),
        F.col("issue_id").cast("string").alias("posting_id"),
        "company", "title", "location", "url", "category",
    )
    return taken, judged.where("reason IS NOT NULL")
