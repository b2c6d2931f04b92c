"""US places: normal form, remote scope and places abroad."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacantia.dims import STATE_NAMES
from vacantia.functions.bind import let
from vacantia.functions.places import text_map
from vacantia.rules import lexicon as lex

CODES = "|".join(STATE_NAMES)
NAMES = "|".join(sorted((n.lower() for n in STATE_NAMES.values()), key=lambda n: (-len(n), n)))
COUNTRY = r"(?i)(?:united states(?: of america)?|usa|u\.s\.a?\.?|us)"
PARTS = r"[;\n•]"
TAIL = r"(?i)[ ,(-]+(?:united states(?: of america)?|usa|u\.s\.|us)\)?$"
BY_CODE = rf"^(?:(.*?)[ ,(-]+)?({CODES})\)?$"
BY_NAME = rf"(?i)^(?:(.*?)[ ,(-]+)?({NAMES})$"
# State first, town second: "WA - Seattle", "Headquarters - Maryland - Columbia".
BY_LEAD = (
    rf"^(?:(?i:headquarters|us) - )?(?:({CODES})|((?i:{NAMES}))) - ([^,-]*[^,\s-])(?:[\s,-].*)?$"
)
REMOTE = r"(?i)\bremote\b"
ABROAD = rf"(?i)\b(?:{'|'.join(lex.ABROAD)}|worldwide|global|non-us|international)\b"


def _code_of() -> Column:
    return text_map({name.lower(): code for code, name in STATE_NAMES.items()})


def parts(location: Column) -> Column:
    """The places of a location text, blanks evened out and headquarter marks dropped."""
    clean = F.transform(
        F.split(F.coalesce(location, F.lit("")), PARTS),
        lambda p: F.regexp_replace(
            F.trim(F.regexp_replace(F.regexp_replace(p, r"D\.C\.", "DC"), r"\s+", " ")),
            r"(?i) - (?:hq|headquarters)$", "",
        ),
    )
    return F.filter(clean, lambda p: p != "")


def _bare(part: Column) -> Column:
    """A place without its remote mark and brackets."""
    bare = F.regexp_replace(F.regexp_replace(part, REMOTE, ""), r"[()]", " ")
    return F.regexp_replace(F.trim(bare), r"^[ ,-]+|[ ,-]+$", "")


def _match(s: Column) -> Column:
    """State code, state name and town of a place, by whichever pattern fits."""
    short = s["short"]
    code, name, lead = short.rlike(BY_CODE), short.rlike(BY_NAME), short.rlike(BY_LEAD)

    def group(by_code: int | None, by_name: int | None, by_lead: int) -> Column:
        none = F.lit("")
        return (
            F.when(code, F.regexp_extract(short, BY_CODE, by_code) if by_code else none)
            .when(name, F.regexp_extract(short, BY_NAME, by_name) if by_name else none)
            .when(lead, F.regexp_extract(short, BY_LEAD, by_lead))
            .otherwise(none)
        )

    return F.struct(
        s["part"].alias("part"), s["bare"].alias("bare"), s["remote"].alias("remote"),
        (short != s["bare"]).alias("tail"),
        group(2, None, 1).alias("coded"),
        F.lower(group(None, 2, 2)).alias("named"),
        group(1, 1, 3).alias("town"),
    )


def _state(m: Column) -> Column:
    town = F.regexp_replace(
        F.regexp_replace(m["town"], rf"(?i)[ ,-]+(?:{NAMES})$", ""), r"^[ ,-]+|[ ,-]+$", ""
    )
    code = F.when(m["coded"] != "", m["coded"]).when(
        m["named"] != "", F.try_element_at(_code_of(), m["named"])
    )
    return F.struct(
        m["part"].alias("part"), m["bare"].alias("bare"), m["remote"].alias("remote"),
        m["tail"].alias("tail"), town.alias("town"),
        F.when(~((m["coded"] == "") & town.isin(*lex.FOREIGN_TWINS)), code).alias("state"),
    )


def _place(m: Column) -> Column:
    known, remote, bare = m["state"].isNotNull(), m["remote"], m["bare"]
    broad = m["tail"] | bare.rlike(rf"^{COUNTRY}$") | (remote & (bare == ""))
    us = known | (broad & ~bare.rlike(ABROAD))
    form = (
        F.when(known & remote, F.concat(F.lit("Remote, "), m["state"]))
        .when(known & (m["town"] != ""), F.concat(m["town"], F.lit(", "), m["state"]))
        .when(known, m["state"])
        .when(remote, F.lit("Remote (US)"))
        .otherwise(F.lit("United States"))
    )
    return F.struct(
        F.when(us, form).otherwise(m["part"]).alias("text"),
        m["state"].alias("state"),
        us.alias("us"),
        remote.alias("remote"),
        (remote & (bare == "")).alias("bare_remote"),
    )


def read_place(part: Column) -> Column:
    """One place as (text, state, us, remote, bare_remote): the stored form, if in the US."""
    first = F.struct(
        part.alias("part"), _bare(part).alias("bare"), part.rlike(REMOTE).alias("remote")
    )
    return let(
        first,
        lambda f: let(
            F.struct(
                f["part"].alias("part"), f["bare"].alias("bare"), f["remote"].alias("remote"),
                F.regexp_replace(f["bare"], TAIL, "").alias("short"),
            ),
            lambda s: let(_match(s), lambda m: let(_state(m), _place)),
        ),
    )


def _kept(places: Column) -> Column:
    """US places. A bare remote beside places abroad only is remote from there."""
    fixed = F.filter(places, lambda p: ~p["bare_remote"])
    home = F.exists(places, lambda p: p["us"] & ~p["bare_remote"])
    return F.when(
        home | (F.size(fixed) == 0), F.filter(places, lambda p: p["us"])
    ).otherwise(F.filter(places, lambda p: p["us"] & ~p["bare_remote"]))


def us_places(location: Column) -> Column:
    """Struct of the kept locations in order, their states and whether one is remote."""

    def summary(kept: Column) -> Column:
        return F.struct(
            F.array_distinct(F.transform(kept, lambda p: p["text"])).alias("locations"),
            F.array_distinct(
                F.array_compact(F.transform(kept, lambda p: p["state"]))
            ).alias("states"),
            F.exists(kept, lambda p: p["remote"]).alias("remote"),
        )

    places = F.transform(parts(location), read_place)
    return let(places, lambda ps: let(_kept(ps), summary))


def remote_scope(location: Column) -> Column:
    return us_places(location)["remote"]


def title_place(t: Column) -> Column:
    """(kind, name) of the place a normalised title ends with: home, abroad or twin, by its longest run of words.

    Both are null if the title ends with no known place.
    """
    home = [n.lower() for n in STATE_NAMES.values()] + lex.HOME_NAMES
    kinds = {"home": home, "twin": lex.CITY_TWINS, "abroad": lex.ABROAD + lex.CITIES_ABROAD}
    ends = sorted({name.split(" ")[-1] for names in kinds.values() for name in names})

    def last(text: Column) -> Column:
        return F.substring_index(F.rtrim(text), " ", -1)

    def judge(w: Column) -> Column:
        found = []
        for n in range(lex.PLACE_WORDS, 0, -1):
            run = F.array_join(F.slice(w, F.greatest(F.size(w) - n + 1, F.lit(1)), F.lit(n)), " ")
            whole = F.size(w) >= n
            found += [
                F.when(whole & run.isin(names), F.struct(F.lit(kind).alias("kind"), run.alias("name")))
                for kind, names in kinds.items()
            ]
        return F.coalesce(*found)

    # Most titles end with no place's last word and are not looked at further.
    bare = F.when(last(t).isin(lex.PLACE_TAILS), F.regexp_replace(t, lex.PLACE_TAIL, " ")).otherwise(t)
    return F.when(last(bare).isin(ends), let(F.split(F.trim(bare), " "), judge))


def placed_abroad(t: Column, locations: Column | None = None) -> Column:
    """A normalised title that puts the job outside the country.

    It ends with a place abroad, or is located in a country. A city whose name is a town's at home too is abroad unless
    one of the posting's US ``locations`` is that town.
    """
    def judge(place: Column) -> Column:
        own = F.lit(False) if locations is None else F.exists(
            F.coalesce(locations, F.array().cast("array<string>")),
            lambda l: F.startswith(F.lower(l), F.concat(place["name"], F.lit(", "))),
        )
        return F.coalesce((place["kind"] == "abroad") | ((place["kind"] == "twin") & ~own), F.lit(False))

    return let(title_place(t), judge) | t.rlike(lex.ABROAD_TITLE)


def drop_foreign(location: Column, t: Column) -> Column:
    """US places of a posting, none when its title places it abroad."""
    none = F.array().cast("array<string>")
    return let(
        us_places(location)["locations"], lambda kept: F.when(placed_abroad(t, kept), none).otherwise(kept)
    )
