"""What a posting's text says about years of experience, new graduates and clearance.

The whole text is read: it is cut into sentences and each is judged on its own. Within a sentence
only the clause that is marked optional falls away, and of age bars and of counts about the employer
only the words themselves, so a requirement beside them still counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacantia.functions.bind import let

# Patterns over a lower-case posting text.
SENTENCE = r"[.!?]+\s+|[;\n•]+"
MARK = r"(?:preferred|ideally|nice to have|nice-to-have|in lieu of|in place of)"
# A sentence that opens with "ideally" or with a heading of the mark is optional as a whole.
HEADING = r"^\W*(?:ideally\b|(?:preferred|nice[- ]to[- ]have)[^,:]*:)"
# A list ended by the mark ("5 years of a, b, or c preferred") is optional back to its count. Matches
# start where a clause starts and give nothing back, so that a long sentence is read once.
_CLAUSE = r"(?:^|(?<=[,()]))"
OPTIONAL = (
    rf"{_CLAUSE}[^,()0-9]*+[0-9][^,()]*+(?:,[^,()0-9]*+)*?, *or [^,()0-9]*?{MARK}[^,()]*+"
    rf"|{_CLAUSE}[^,()]*?{MARK}[^,()]*+"
)
AGE = r"[0-9]+\+? ?(?:years? old|years? of age)"
# What a clause is about is read before its count. A clause that speaks of the employer there, and
# asks nothing of the reader, tells of the employer's years.
BEFORE_COUNT = r"^[^0-9]*"
EMPLOYER = (
    r"\b(?:our|we|we've|company|firm|with over|for over|for more than|founded|established|history of)\b"
)
DEMAND = (
    r"\b(?:requir|need|seek|look|want|expect|ask|must|minimum|at least|you|candidate|applicant|should|hir|qualif)"
)
EMPLOYER_COUNT = r"^[^0-9]*[0-9]+\+? ?(?:years?|yrs?)(?: of experience)?"
# Years gone by: "over the past 25 years", "for 40 years, we".
GONE_BY = (
    r"(?:past|last) [0-9]+\+? ?(?:years?|yrs?)"
    r"|for (?:over |nearly |almost |more than )?[0-9]+\+? ?(?:years?|yrs?),? (?:our|we|the (?:company|firm))\b"
)
# Fixed value: characters between a degree and its count. Further apart the two are not read together.
DEGREE_REACH = 30
# Numbers in words.
NUMBERS = {
    "one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9,
    "ten": 10, "eleven": 11, "twelve": 12, "fifteen": 15, "twenty": 20,
}
# What may stand between a number in words and its unit: the digits again, the end of a range.
WORD_TAIL = r"((?: ?\([0-9]+\))?\+? ?(?:(?:-|–|to) ?[a-z0-9]+\+? ?)?(?:years?|yrs?|months?))"
COUNT = r"([0-9]{1,3})\)?\+?(?: ?(?:-|–|to) ?[0-9]+\+?)? ?(?:years|year|yrs|yr)"
# Months count if they are months of experience.
MONTHS = r"([0-9]{1,3})\)?\+?(?: ?(?:-|–|to) ?[0-9]+\+?)? ?months?'? (?:of )?(?:[a-z-]+ ){0,3}experience"
DEGREE = r"(?:bachelor|master|doctora|phd|ph\.d|degree|\bbs\b|\bms\b|\bba\b)"
ROUTE = (
    r"(?:bachelor'?s?|master'?s?|doctora(?:l|te)|phd|\bbs\b|\bms\b)"
    rf"[^0-9;]{{0,{DEGREE_REACH}}}([0-9]{{1,3}})"
)
YEARS = r"years?|yrs?|months?"
# Words without which the patterns above cannot match: a plain scan for them comes first.
YEAR_WORDS = ("year", "yr", "month")
CEILING_WORDS = ("year", "experience")
EARLY_WORDS = ("year", "experience", "entry")
NEWGRAD_WORDS = ("grad", "degree", "recently")
CLEARANCE_WORDS = ("clearance", "trust", "citizen", "ts/sci", "secret")
CEILING = (
    r"(?:^|[^0-9])0 ?(?:-|–|to) ?2 years|no prior experience|"
    r"no (?:work )?experience (?:is )?(?:required|necessary|needed)|less than (?:2|two) years"
)
SAYS_EARLY = (
    r"(?:^|[^0-9])0 ?(?:-|–|to) ?2 years|no prior experience|"
    r"entry[- ]level (?:role|position|opportunity)"
)
SAYS_NEWGRAD = (
    r"(?:open to|seeking|looking for|hiring) (?:recent|new) grad|new grad(?:uate)? (?:role|position)|"
    r"degree (?:earned|completed) (?:recently|within)|recently (?:earned|completed) (?:a|your)"
)
CLEARANCE = (
    r"clearance|public trust|(?:u\.?s\.?|united states) citizen|ts/sci|top secret"
)
NO_CLEARANCE = r"\b(?:no|without a) (?:security )?clearance"


def _any(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(w)) for w in words])


def _in_digits(sentence: Column) -> Column:
    """Counts of years written in words, in digits."""
    spelled = sentence
    for word, number in NUMBERS.items():
        spelled = F.regexp_replace(spelled, rf"\b{word}{WORD_TAIL}", f"{number}$1")
    return F.when(sentence.rlike(rf"\b(?:{'|'.join(NUMBERS)}){WORD_TAIL}"), spelled).otherwise(sentence)


def _about_reader(sentence: Column) -> Column:
    """A sentence without the counts of clauses that are about the employer."""
    def clause(c: Column) -> Column:
        subject = F.regexp_extract(c, BEFORE_COUNT, 0)
        own = subject.rlike(EMPLOYER) & ~subject.rlike(DEMAND)
        return F.when(own, F.regexp_replace(c, EMPLOYER_COUNT, " ")).otherwise(c)

    told = F.regexp_replace(F.regexp_replace(sentence, AGE, " "), GONE_BY, " ")
    clauses = F.array_join(F.transform(F.split(told, ","), clause), ",")
    return F.when(told.rlike(EMPLOYER), clauses).otherwise(told)


def _required(sentence: Column) -> Column:
    """A sentence without what it marks optional, age bars and counts about the employer."""
    told = _about_reader(sentence)
    return F.when(sentence.rlike(MARK), F.regexp_replace(told, OPTIONAL, " ")).otherwise(told)


def _numbers(found: Column) -> Column:
    return F.transform(found, lambda n: n.cast("int"))


def _asked(sentence: Column) -> Column:
    """Years that a sentence counts; months are whole years of them."""
    years = _numbers(F.regexp_extract_all(sentence, F.lit(COUNT), F.lit(1)))
    months = _numbers(F.regexp_extract_all(sentence, F.lit(MONTHS), F.lit(1)))
    whole = F.transform(months, lambda n: F.floor(n / 12).cast("int"))
    return F.when(F.contains(sentence, F.lit("month")), F.concat(years, whole)).otherwise(years)


def facts(text: Column) -> Column:
    """Struct of floor, highest count, ceiling and the two level statements.

    Sentences without a degree each ask for their count, so the largest is the floor;
    sentences naming degrees are routes, of which the easiest counts. Only lines that hold one of the words looked for
    are read closely.
    """

    def ask(lines: Column) -> Column:
        sentences = F.flatten(F.transform(F.filter(lines, lambda x: _any(x, YEAR_WORDS)), lambda x: F.split(x, SENTENCE)))
        dated = F.filter(sentences, lambda s: _any(s, YEAR_WORDS) & ~s.rlike(HEADING))
        required = F.transform(dated, lambda s: _required(_in_digits(s)))
        return F.filter(required, lambda s: _any(s, YEAR_WORDS) & s.rlike("[0-9]"))

    def counts(asked: Column) -> Column:
        plain = F.transform(F.filter(asked, lambda s: ~s.rlike(DEGREE)), _asked)
        routes = F.transform(
            F.filter(asked, lambda s: s.rlike(DEGREE)),
            lambda s: F.concat(_asked(s), _numbers(F.regexp_extract_all(s, F.lit(ROUTE), F.lit(1)))),
        )
        return F.struct(F.flatten(plain).alias("plain"), F.flatten(routes).alias("routes"))

    def statements(lines: Column) -> Column:
        def said(words: tuple[str, ...], pattern: str) -> Column:
            return F.exists(lines, lambda x: _any(x, words) & x.rlike(pattern))

        return F.struct(
            said(CEILING_WORDS, CEILING).alias("ceiling"),
            said(EARLY_WORDS, SAYS_EARLY).alias("says_early"),
            said(NEWGRAD_WORDS, SAYS_NEWGRAD).alias("says_newgrad"),
            let(ask(lines), counts).alias("counts"),
        )

    def judge(s: Column) -> Column:
        plain, routes = s["counts"]["plain"], s["counts"]["routes"]
        return F.struct(
            F.when(s["ceiling"], F.lit(0))
            .otherwise(F.greatest(F.array_max(plain), F.array_min(routes)))
            .alias("floor"),
            F.greatest(F.array_max(plain), F.array_max(routes)).alias("highest"),
            s["ceiling"].alias("ceiling"),
            s["says_early"].alias("says_early"),
            s["says_newgrad"].alias("says_newgrad"),
        )

    words = tuple(dict.fromkeys(YEAR_WORDS + CEILING_WORDS + EARLY_WORDS + NEWGRAD_WORDS))
    lines = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "\n"), lambda x: _any(x, words))
    return let(let(lines, statements), judge)


def years_floor(text: Column) -> Column:
    """Required years; null when the posting states none."""
    return facts(text)["floor"]


def clearance(text: Column) -> Column:
    """Clearance, public trust or citizenship mentioned, other than to say none is needed."""
    low = F.lower(F.coalesce(text, F.lit("")))
    said = F.regexp_replace(low, NO_CLEARANCE, " ").rlike(CLEARANCE)
    return _any(low, CLEARANCE_WORDS) & said
