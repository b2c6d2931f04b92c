"""Level of a posting, from its title or from its text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacantia.functions import dates
from vacantia.rules import lexicon as lex
from vacantia.rules import roles
from vacantia.rules.match import has
from vacantia.rules.rejects import is_multi_level, season_end


def level_from_title(t: Column, as_of: str) -> Column:
    """intern, newgrad or earlycareer by the words of the title, else null."""
    seasonal = has(t, lex.SEASON_YEAR)
    big_start = seasonal & has(t, lex.ASSOCIATE) & ~has(t, lex.INTERN)
    past_year = has(t, lex.DATED) & (season_end(t) < dates.day(as_of))
    newgrad = has(t, lex.NEWGRAD) & ~has(t, lex.PROGRAM_STAFF)
    return (
        F.when(has(t, lex.INTERN), F.lit("intern"))
        .when(F.coalesce(past_year, F.lit(False)), F.lit(None).cast("string"))
        .when(big_start, F.lit("newgrad"))
        .when(seasonal, F.lit("intern"))
        .when(newgrad, F.lit("newgrad"))
        .when(has(t, lex.EARLY) | has(t, lex.NUMERAL), F.lit("earlycareer"))
    )


def multi_level_ok(t: Column, floor: Column) -> Column:
    """A title spanning levels counts only if the posting's easiest route is short."""
    return ~is_multi_level(t) | F.coalesce(floor <= 2, F.lit(False))


def names_security_itself(t: Column) -> Column:
    """Security work in the title's own words; a bare ``security`` only before some nouns."""
    core = [w for w in lex.CORE if w != "security"]
    term = has(t, core) | has(t, lex.OWN_WORDS) | roles.is_ops_grc_term(t)
    return (
        (term & roles.other_sense(t).isNull() & roles.weak_noun(t).isNull())
        | roles.is_product_role(t)
        | roles.is_team_engineer(t)
    )


def level_from_posting(t: Column, sec_co: Column, facts: Column) -> Column:
    """Level of a title without one, by what the posting says (``experience.facts``)."""
    floor_ok = F.coalesce(facts["floor"] <= 2, F.lit(False))
    counts_ok = F.coalesce(facts["highest"] <= 2, F.lit(False))
    early = (
        facts["says_early"]
        | (has(t, lex.AI_SECURITY) & (facts["ceiling"] | floor_ok))
        | (
            names_security_itself(t)
            & has(t, lex.PRACTITIONER)
            & ~has(t, lex.HIGHER_RANK)
            & ~has(t, lex.SIDE_JOB)
            & counts_ok
        )
        | (sec_co & facts["ceiling"])
    )
    return F.when(facts["says_newgrad"], F.lit("newgrad")).when(early, F.lit("earlycareer"))
