"""Does a title name work the board lists? All functions take a normalised title."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacantia.rules import lexicon as lex
from vacantia.rules.match import first_reason, has

#: A product may stand one word away from its role, a cloud word two.
_PRODUCT_ROLE = (
    f" (?:{'|'.join(lex.PRODUCTS)})(?: [^ ]+)? (?:{'|'.join(lex.PRODUCT_ROLES)}) "
)
_CLOUD_ROLE = (
    f" (?:{'|'.join(lex.CLOUD)})(?: [^ ]+){{0,2}} (?:{'|'.join(lex.CLOUD_ROLES)}) "
)
_CLOUD_LATER = f" (?:{'|'.join(lex.CLOUD_LATER_ROLES)}) (?:.* )?(?:{'|'.join(lex.CLOUD)}) "


def is_security_term(t: Column) -> Column:
    return has(t, lex.CORE)


def is_ops_grc_term(t: Column) -> Column:
    third_party = has(t, lex.THIRD_PARTY) & has(t, lex.THIRD_PARTY_QUALIFIER)
    infrastructure = has(t, lex.CRITICAL_INFRA) & (
        has(t, lex.CRITICAL_INFRA_ROLE) | has(t, lex.INTERN)
    )
    return has(t, lex.OPS_GRC) | third_party | infrastructure


def other_sense(t: Column) -> Column:
    """Which other sense a security-looking word has here; null when it has none."""
    clear = has(t, lex.STRONG)
    chip = has(t, ["soc"]) & (has(t, lex.CHIP_BESIDE) | has(t, lex.CHIP_SOC))
    return first_reason(
        regulator=has(t, lex.SEC_FILER) & ~clear,
        financial_audit=has(t, lex.FINANCIAL_AUDIT) & ~clear,
        medical=has(t, lex.MEDICAL) & has(t, lex.MEDICAL_TERM) & ~clear,
        military=has(t, lex.MILITARY_THREAT) & ~clear,
        chip=chip & ~clear,
    )


def is_product_role(t: Column) -> Column:
    observability = has(t, ["splunk"]) & has(t, lex.OBSERVABILITY)
    return t.rlike(_PRODUCT_ROLE) & ~observability & ~has(t, lex.SOLUTIONS)


def is_team_engineer(t: Column) -> Column:
    return has(t, lex.TEAM_TITLES) & has(t, lex.TEAM_WORDS)


def is_cloud_role(t: Column) -> Column:
    leads = t.rlike(_CLOUD_ROLE) | has(t, lex.CLOUD_OPS) | t.rlike(_CLOUD_LATER)
    return (
        F.when(has(t, lex.CLOUD_INFRASTRUCTURE), leads)
        .when(has(t, lex.CLOUD_OUT), F.lit(False))
        .otherwise(leads)
    )


def has_level_word(t: Column) -> Column:
    """An internship, new-grad or early-career word; a bare numeral is none."""
    return has(t, lex.INTERN) | has(t, lex.SEASON_YEAR) | has(t, lex.NEWGRAD) | has(t, lex.EARLY_WORD)


def is_solutions_role(t: Column, sec_co: Column) -> Column:
    designs = has(t, lex.SOLUTIONS) & (sec_co | ~has(t, lex.SOLUTIONS_OUT))
    sells = has(t, lex.SALES_ENGINEER) & has(t, lex.TECHNOLOGY)
    return has_level_word(t) & (designs | sells)


def weak_noun(t: Column) -> Column:
    """Why a security word does not carry this title; null when it does."""
    return first_reason(
        weak_noun=has(t, lex.WEAK_NOUN) & ~has(t, lex.SECOND_TERM),
        guard_officer=has(t, lex.OFFICER) & ~has(t, lex.OFFICER_OK),
        audit_report=(has(t, lex.SOC_ONE) & ~has(t, lex.SOC_TWO))
        | (has(t, lex.SOC_SERVICES) & has(t, lex.ASSURANCE)),
        crime_lab=has(t, lex.FORENSIC) & has(t, lex.LAB) & ~has(t, lex.DIGITAL),
    )


def sec_company_role(t: Column, sec_co: Column) -> Column:
    """At a security company a technical title word is enough."""
    technical = has(t, lex.TECHNICAL) | has(t, lex.SALES_ENGINEER)
    function_job = (
        has(t, lex.SOFT_TECHNICAL)
        & ~has(t, lex.HARD_TECHNICAL)
        & has(t, lex.BUSINESS_FUNCTION)
        & ~is_security_term(t)
    )
    return sec_co & technical & ~function_job


def names_security(t: Column) -> Column:
    """Security work by term, product or team."""
    term = (
        (is_security_term(t) | is_ops_grc_term(t))
        & other_sense(t).isNull()
        & weak_noun(t).isNull()
    )
    return term | is_product_role(t) | is_team_engineer(t)
