"""The title rules written a second time, in SQL, over the same word lists."""

from __future__ import annotations

from vacantia.plans.oracle import has, q
from vacantia.rules import experience as exp
from vacantia.rules import lexicon as lex


def alt(words: list[str]) -> str:
    return "(?:" + "|".join(words) + ")"


def rx(pattern: str, column: str = "t") -> str:
    return f"regexp_matches({column}, {q(pattern)})"


def first(**tests: str) -> str:
    cases = " ".join(f"WHEN {test} THEN {q(name.replace('_', ' '))}" for name, test in tests.items())
    return f"CASE {cases} END"


CORE = has(lex.CORE)
STRONG = has(lex.STRONG)
OPS = (
    f"({has(lex.OPS_GRC)} OR ({has(lex.THIRD_PARTY)} AND {has(lex.THIRD_PARTY_QUALIFIER)})"
    f" OR ({has(lex.CRITICAL_INFRA)} AND ({has(lex.CRITICAL_INFRA_ROLE)} OR {has(lex.INTERN)})))"
)
SENSE = f"""CASE WHEN {STRONG} THEN NULL WHEN {has(lex.SEC_FILER)} THEN 'regulator'
  WHEN {has(lex.FINANCIAL_AUDIT)} THEN 'financial audit'
  WHEN {has(lex.MEDICAL)} AND {has(lex.MEDICAL_TERM)} THEN 'medical'
  WHEN {has(lex.MILITARY_THREAT)} THEN 'military'
  WHEN {has(['soc'])} AND ({has(lex.CHIP_BESIDE)} OR {has(lex.CHIP_SOC)}) THEN 'chip' END"""
PRODUCT = (
    f"({rx(' ' + alt(lex.PRODUCTS) + '( [^ ]+)? ' + alt(lex.PRODUCT_ROLES) + ' ')}"
    f" AND NOT ({has(['splunk'])} AND {has(lex.OBSERVABILITY)}) AND NOT {has(lex.SOLUTIONS)})"
)
TEAM = f"({has(lex.TEAM_TITLES)} AND {has(lex.TEAM_WORDS)})"
CLOUD_LEADS = (
    f"({rx(' ' + alt(lex.CLOUD) + '( [^ ]+){0,2} ' + alt(lex.CLOUD_ROLES) + ' ')} OR "
    f"{has(lex.CLOUD_OPS)} OR {rx(' ' + alt(lex.CLOUD_LATER_ROLES) + ' (.* )?' + alt(lex.CLOUD) + ' ')})"
)
CLOUD = f"({CLOUD_LEADS} AND ({has(lex.CLOUD_INFRASTRUCTURE)} OR NOT {has(lex.CLOUD_OUT)}))"
LEVEL_WORD = " OR ".join(
    has(words) for words in (lex.INTERN, lex.SEASON_YEAR, lex.NEWGRAD, lex.EARLY_WORD)
)
SOLUTIONS = f"""(({LEVEL_WORD}) AND (({has(lex.SOLUTIONS)} AND (sec_co OR NOT {has(lex.SOLUTIONS_OUT)}))
  OR ({has(lex.SALES_ENGINEER)} AND {has(lex.TECHNOLOGY)})))"""
WEAK = f"""CASE WHEN {has(lex.WEAK_NOUN)} AND NOT {has(lex.SECOND_TERM)} THEN 'weak noun'
  WHEN {has(lex.OFFICER)} AND NOT {has(lex.OFFICER_OK)} THEN 'guard officer'
  WHEN {has(lex.SOC_ONE)} AND NOT {has(lex.SOC_TWO)} THEN 'audit report'
  WHEN {has(lex.SOC_SERVICES)} AND {has(lex.ASSURANCE)} THEN 'audit report'
  WHEN {has(lex.FORENSIC)} AND {has(lex.LAB)} AND NOT {has(lex.DIGITAL)} THEN 'crime lab' END"""
SEC_CO = f"""(sec_co AND ({has(lex.TECHNICAL)} OR {has(lex.SALES_ENGINEER)})
  AND ({CORE} OR {has(lex.HARD_TECHNICAL)} OR NOT {has(lex.SOFT_TECHNICAL)}
    OR NOT {has(lex.BUSINESS_FUNCTION)}))"""
SECURE = f"((({CORE} OR {OPS}) AND ({SENSE}) IS NULL AND ({WEAK}) IS NULL) OR {PRODUCT} OR {TEAM})"
SPAN = has(lex.SPAN)

_PLAIN = f"regexp_replace(t, {q(' ' + alt(lex.NOT_A_RANK) + ' ')}, ' ', 'g')"
SENIORITY = (
    f"({has(lex.SENIOR, _PLAIN)} OR ({has(lex.ASSOCIATE_PARTNER)} AND NOT "
    f"{has(lex.ASSOCIATE_PARTNER_OK)}) OR ({has(lex.HIGH)} AND NOT {SPAN}) OR "
    f"({has(['architect'])} AND NOT ({LEVEL_WORD})))"
)
PHYSICAL = (
    f"({has(lex.PHYSICAL)} OR ({has(lex.GUARD_CENTER)} AND NOT {has(lex.INFO_OR_CYBER)}) OR "
    f"({has(lex.OFFICER)} AND NOT {has(lex.OFFICER_OK)}))"
)
OTHER = (
    f"(({has(lex.OTHER_SECURITY)} OR ({has(lex.CORPORATE_SECURITY)} AND NOT "
    f"{has(lex.CORPORATE_ENGINEER)})) AND NOT {has(lex.CYBER)} AND NOT {has(lex.SOLUTIONS)})"
)
BUSINESS = (
    f"({has(lex.BUSINESS)} OR ({has(lex.SALES)} AND NOT {has(lex.SALES_ENGINEER)}) OR "
    f"({has(lex.INTERNAL_AUDIT)} AND NOT {has(lex.TECH_AUDIT)}) OR ({has(lex.UNDERWRITING)} AND NOT "
    f"{has(lex.UNDERWRITING_OK)}) OR ({has(lex.SUPPORT_FUNCTION)} AND NOT secure))"
)
REJECT = first(
    seniority=SENIORITY,
    physical_security=PHYSICAL,
    other_security=OTHER,
    business_function=BUSINESS,
    hardware=f"({has(lex.HARDWARE)} OR ({has(lex.SILICON)} AND NOT secure))",
    placeholder=has(lex.PLACEHOLDER),
    closed_program=has(lex.CLOSED_PROGRAM),
    plant_security=f"({has(lex.PLANT)} OR {rx(lex.PAY_RATE, 'title')})",
)


def season_over(as_of: str) -> str:
    season = (
        f"coalesce(nullif(regexp_extract(t, ' ({lex.SEASON}) {lex.YEAR} ', 1), ''),"
        f" nullif(regexp_extract(t, ' {lex.YEAR} ({lex.SEASON}) ', 1), ''))"
    )
    year = f"TRY_CAST(regexp_extract(t, ' ({lex.YEAR}) ', 1) AS INTEGER)"
    month = f"CASE {season} WHEN 'spring' THEN 5 WHEN 'summer' THEN 8 WHEN 'winter' THEN 3 ELSE 12 END"
    return f"coalesce(last_day(make_date({year}, {month}, 1)) < DATE '{as_of}', FALSE)"


def level(as_of: str) -> str:
    seasonal = has(lex.SEASON_YEAR)
    return f"""CASE WHEN {has(lex.INTERN)} THEN 'intern'
  WHEN {has(lex.DATED)} AND {season_over(as_of)} THEN NULL
  WHEN {seasonal} AND {has(lex.ASSOCIATE)} THEN 'newgrad' WHEN {seasonal} THEN 'intern'
  WHEN {has(lex.NEWGRAD)} AND NOT {has(lex.PROGRAM_STAFF)} THEN 'newgrad'
  WHEN {has(lex.EARLY)} OR {has(lex.NUMERAL)} THEN 'earlycareer' END"""


_INNER = [w for w in lex.CORE if w != "security"]
OWN = (
    f"((({has(_INNER)} OR {has(lex.OWN_WORDS)} OR {OPS}) AND ({SENSE}) IS NULL AND ({WEAK}) IS NULL)"
    f" OR {PRODUCT} OR {TEAM})"
)
POSTING_LEVEL = f"""CASE WHEN says_newgrad THEN 'newgrad' WHEN says_early THEN 'earlycareer'
  WHEN {has(lex.AI_SECURITY)} AND (ceiling OR coalesce(floor <= 2, FALSE)) THEN 'earlycareer'
  WHEN {OWN} AND {has(lex.PRACTITIONER)} AND NOT {has(lex.HIGHER_RANK)} AND NOT {has(lex.SIDE_JOB)}
    AND coalesce(highest <= 2, FALSE) THEN 'earlycareer'
  WHEN sec_co AND ceiling THEN 'earlycareer' END"""

_LISTED = "(secure OR sec_co)"
CATEGORY = (
    f"CASE WHEN {_LISTED} AND {has(lex.SOC_TWO)} THEN 'GRC & Risk' "
    + " ".join(
        f"WHEN {_LISTED} AND {has(words)} THEN {q(name)}"
        for name, words in lex.CATEGORY_TERMS.items()
    )
    + f""" WHEN secure THEN 'Security Engineering' WHEN cloud THEN 'Cloud Engineering'
  WHEN solutions AND NOT (sec_co AND {has(lex.SALES_ENGINEER)}) THEN 'Solutions Architecture'
  WHEN at_sec_co THEN 'Engineering @ Security Co' END"""
)


def facts(source: str, key: str, text: str) -> str:
    """CTEs ending in ``fact`` with what the text column says about experience."""

    def numbers(s: str, pattern: str) -> str:
        return f"list_transform(regexp_extract_all({s}, {q(pattern)}, 1), lambda n: CAST(n AS INTEGER))"

    def required(s: str) -> str:
        for word, number in exp.NUMBERS.items():
            s = f"regexp_replace({s}, {q(chr(92) + 'b' + word + exp.WORD_TAIL)}, '{number}{chr(92)}1', 'g')"
        clause = f"[^,()]*{exp.MARK}[^,()]*"
        listed = f"[^,()]*[0-9][^,()]*(?:,[^,()0-9]*)*, *or [^,()0-9]*{exp.MARK}[^,()]*"
        for pattern in (exp.AGE, exp.GONE_BY):
            s = f"regexp_replace({s}, {q(pattern)}, ' ', 'g')"
        subject = f"regexp_extract(c, {q(exp.BEFORE_COUNT)})"
        s = f"""array_to_string(list_transform(string_split({s}, ','), lambda c: CASE WHEN regexp_matches({subject},
          {q(exp.EMPLOYER)}) AND NOT regexp_matches({subject}, {q(exp.DEMAND)})
          THEN regexp_replace(c, {q(exp.EMPLOYER_COUNT)}, ' ') ELSE c END), ',')"""
        return f"regexp_replace({s}, {q(f'{listed}|{clause}')}, ' ', 'g')"

    def years(s: str) -> str:
        months = f"list_transform({numbers(s, exp.MONTHS)}, lambda n: n // 12)"
        return f"({numbers(s, exp.COUNT)} || {months})"

    return f"""
low AS (SELECT {key}, lower(coalesce({text}, '')) AS low FROM {source}),
dated AS (SELECT {key}, low, list_filter(regexp_split_to_array(low, {q(exp.SENTENCE)}), lambda s:
  regexp_matches(s, {q(exp.YEARS)}) AND NOT regexp_matches(s, {q(exp.HEADING)})) AS said FROM low),
asked AS (SELECT {key}, low, list_filter(list_transform(said, lambda s: {required('s')}), lambda s:
  regexp_matches(s, {q(exp.YEARS)}) AND regexp_matches(s, '[0-9]')) AS ask FROM dated),
counted AS (SELECT {key}, low,
  flatten(list_transform(list_filter(ask, lambda s: NOT regexp_matches(s, {q(exp.DEGREE)})),
    lambda s: {years('s')})) AS plain,
  flatten(list_transform(list_filter(ask, lambda s: regexp_matches(s, {q(exp.DEGREE)})),
    lambda s: {years('s')} || {numbers('s', exp.ROUTE)})) AS routes FROM asked),
fact AS (SELECT {key}, CASE WHEN regexp_matches(low, {q(exp.CEILING)}) THEN 0
    ELSE greatest(list_max(plain), list_min(routes)) END AS floor,
  greatest(list_max(plain), list_max(routes)) AS highest,
  regexp_matches(low, {q(exp.CEILING)}) AS ceiling,
  regexp_matches(low, {q(exp.SAYS_EARLY)}) AS says_early,
  regexp_matches(low, {q(exp.SAYS_NEWGRAD)}) AS says_newgrad FROM counted)"""
