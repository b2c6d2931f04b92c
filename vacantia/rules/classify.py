"""The full verdict over a posting table.

Every rule is a column, so a posting is judged in one pass without a shuffle. Columns
needed by several later rules are staged one projection earlier, which lets Spark
compute each regular expression once per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.functions.text import title_text
from vacantia.rules import experience, level, lexicon, rejects, roles, usplaces
from vacantia.rules.match import has


def category(
    t: Column, sec_co: Column, secure: Column, cloud: Column, solutions: Column, at_sec_co: Column
) -> Column:
    """One of the categories, narrow ones first; null for a title that names no listed work.

    The last four arguments are the role tests, which a caller has at hand.
    """
    listed = secure | sec_co
    sells = sec_co & has(t, lexicon.SALES_ENGINEER)
    named = [
        F.when(listed & has(t, words), F.lit(name))
        for name, words in lexicon.CATEGORY_TERMS.items()
    ]
    return F.coalesce(
        F.when(listed & has(t, lexicon.SOC_TWO), F.lit("GRC & Risk")),
        *named,
        F.when(secure, F.lit("Security Engineering")),
        F.when(cloud, F.lit("Cloud Engineering")),
        F.when(solutions & ~sells, F.lit("Solutions Architecture")),
        F.when(at_sec_co, F.lit("Engineering @ Security Co")),
    )


def _settled(frame: DataFrame, keep: list[str], result: Column) -> DataFrame:
    """Result columns that a later filter reads instead of working them out again.

    Spark moves a filter below a projection by writing the projected expressions into it,
    which for a verdict repeats every rule many times over. It does not move one below a
    generator, so the result passes through a one-element ``inline``.
    """
    return frame.select(*keep, F.inline(F.array(result)))


def classify(postings: DataFrame, as_of: str) -> DataFrame:
    """Adds verdict, reason, type, category and places to (title, description, location, sec_co).

    The reason is the first test a posting fails, in the order role, always out, place,
    level, years, season.
    """
    t, sec_co = F.col("t"), F.col("sec_co")
    staged = postings.withColumn("t", title_text(F.col("title"))).withColumns(
        {
            "secure": roles.names_security(t),
            "cloud": roles.is_cloud_role(t),
            "solutions": roles.is_solutions_role(t, sec_co),
            "at_sec_co": roles.sec_company_role(t, sec_co),
            "spans_levels": rejects.is_multi_level(t),
            "title_level": level.level_from_title(t, as_of),
            "facts": experience.facts(F.col("description")),
            "us": usplaces.us_places(F.col("location")),
        }
    )
    judged = staged.withColumns(
        {
            "abroad": usplaces.placed_abroad(t, F.col("us.locations")),
            "rejected": rejects.reject_reason(t, F.col("secure"), F.col("title")),
            "type": F.coalesce(
                F.when(~F.col("spans_levels") | (F.col("title_level") == "intern"), F.col("title_level")),
                F.when(
                    F.col("spans_levels"),
                    F.when(F.col("facts.floor") <= 2, F.coalesce("title_level", F.lit("earlycareer"))),
                ),
                F.when(~F.col("spans_levels"), level.level_from_posting(t, sec_co, F.col("facts"))),
            ),
            "category": category(
                t, sec_co, F.col("secure"), F.col("cloud"), F.col("solutions"), F.col("at_sec_co")
            ),
        }
    )
    role = F.col("secure") | F.col("cloud") | F.col("solutions") | F.col("at_sec_co")
    full_time = F.col("type") != "intern"
    reason = (
        F.when(~role, F.lit("role"))
        .when(F.col("rejected").isNotNull(), F.col("rejected"))
        .when(F.col("abroad") | (F.size("us.locations") == 0), F.lit("place"))
        .when(F.col("type").isNull(), F.lit("level"))
        .when(full_time & F.coalesce(F.col("facts.floor") > 2, F.lit(False)), F.lit("years"))
        .when(rejects.is_stale_season(t, F.col("type"), as_of), F.lit("season"))
    )
    verdict_of = F.when(F.col("reason").isNull(), F.lit("in")).otherwise(F.lit("out"))
    result = F.struct(
        verdict_of.alias("verdict"), F.col("reason"), F.col("type"), F.col("category"),
        F.col("us.locations").alias("us_locations"),
        F.col("us.states").alias("us_states"),
        F.col("us.remote").alias("us_remote"),
        experience.clearance(F.col("description")).alias("needs_clearance"),
    )
    return _settled(judged.withColumn("reason", reason), postings.columns, result)


def verdict(submissions: DataFrame, as_of: str) -> DataFrame:
    """Check of a submission by title and location alone: a label and every reason."""
    t, sec_co = F.col("t"), F.col("sec_co")
    staged = submissions.withColumn("t", title_text(F.col("title"))).withColumns(
        {
            "secure": roles.names_security(t),
            "title_level": level.level_from_title(t, as_of),
            "us": usplaces.us_places(F.col("location")),
        }
    )
    role = (
        F.col("secure")
        | roles.is_cloud_role(t)
        | roles.is_solutions_role(t, sec_co)
        | roles.sec_company_role(t, sec_co)
    )
    reasons = F.array_compact(
        F.array(
            F.when(~role, F.lit("role")),
            rejects.reject_reason(t, F.col("secure"), F.col("title")),
            F.when(
                F.col("title_level").isNull() | rejects.is_multi_level(t), F.lit("level")
            ),
            F.when(
                usplaces.placed_abroad(t, F.col("us.locations")) | (F.size("us.locations") == 0), F.lit("place")
            ),
            F.when(rejects.is_stale_season(t, F.col("title_level"), as_of), F.lit("season")),
        )
    )
    label = F.when(F.size("reasons") == 0, F.lit("valid")).otherwise(F.lit("needs-fix"))
    result = F.struct(label.alias("label"), F.col("reasons"))
    return _settled(staged.withColumn("reasons", reasons), submissions.columns, result)
