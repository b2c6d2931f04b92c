"""Title families that are always out, each with its exceptions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacantia.functions import dates
from vacantia.rules import lexicon as lex
from vacantia.rules import roles
from vacantia.rules.match import first_reason, has, without


def is_multi_level(t: Column) -> Column:
    """A title posted at several levels that reach the senior one."""
    return has(t, lex.SPAN)


def _seniority(t: Column) -> Column:
    plain = without(t, lex.NOT_A_RANK)
    partner = has(t, lex.ASSOCIATE_PARTNER) & ~has(t, lex.ASSOCIATE_PARTNER_OK)
    high = has(t, lex.HIGH) & ~is_multi_level(t)
    architect = has(t, ["architect"]) & ~roles.has_level_word(t)
    return has(plain, lex.SENIOR) | partner | high | architect


def _physical(t: Column) -> Column:
    center = has(t, lex.GUARD_CENTER) & ~has(t, lex.INFO_OR_CYBER)
    officer = has(t, lex.OFFICER) & ~has(t, lex.OFFICER_OK)
    return has(t, lex.PHYSICAL) | center | officer


def _other_security(t: Column) -> Column:
    corporate = has(t, lex.CORPORATE_SECURITY) & ~has(t, lex.CORPORATE_ENGINEER)
    exempt = has(t, lex.CYBER) | has(t, lex.SOLUTIONS)
    return (has(t, lex.OTHER_SECURITY) | corporate) & ~exempt


def _business(t: Column, secure: Column) -> Column:
    sales = has(t, lex.SALES) & ~has(t, lex.SALES_ENGINEER)
    audit = has(t, lex.INTERNAL_AUDIT) & ~has(t, lex.TECH_AUDIT)
    underwriting = has(t, lex.UNDERWRITING) & ~has(t, lex.UNDERWRITING_OK)
    support = has(t, lex.SUPPORT_FUNCTION) & ~secure
    return sales | has(t, lex.BUSINESS) | audit | underwriting | support


def _hardware(t: Column, secure: Column) -> Column:
    return has(t, lex.HARDWARE) | (has(t, lex.SILICON) & ~secure)


def reject_reason(
    t: Column, secure: Column | None = None, title: Column | None = None
) -> Column:
    """First family that rules a title out; null when none does.

    ``title`` is the title as written, where a pay rate still has its marks.
    """
    paid = F.lit(False) if title is None else F.coalesce(title.rlike(lex.PAY_RATE), F.lit(False))
    secure = roles.names_security(t) if secure is None else secure
    return first_reason(
        seniority=_seniority(t),
        physical_security=_physical(t),
        other_security=_other_security(t),
        business_function=_business(t, secure),
        hardware=_hardware(t, secure),
        placeholder=has(t, lex.PLACEHOLDER),
        closed_program=has(t, lex.CLOSED_PROGRAM),
        plant_security=has(t, lex.PLANT) | paid,
    )


def season_end(t: Column) -> Column:
    """Last day of the season a title names; a bare year lasts to its end.

    Spring ends in May, summer in August, fall in December, winter in March.
    """
    season = F.coalesce(
        F.nullif(F.regexp_extract(t, f" ({lex.SEASON}) {lex.YEAR} ", 1), F.lit("")),
        F.nullif(F.regexp_extract(t, f" {lex.YEAR} ({lex.SEASON}) ", 1), F.lit("")),
    )
    year = F.regexp_extract(t, f" ({lex.YEAR}) ", 1).try_cast("int")
    month = (
        F.when(season == "spring", 5)
        .when(season == "summer", 8)
        .when(season == "winter", 3)
        .otherwise(12)
    )
    return F.last_day(F.make_date(year, month, F.lit(1)))


def is_stale_season(t: Column, kind: Column, as_of: str) -> Column:
    """An internship whose season is over on the as-of day."""
    over = season_end(t) < dates.day(as_of)
    return (kind == "intern") & F.coalesce(over, F.lit(False))
