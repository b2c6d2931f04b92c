"""Location columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vacantia.dims import STATE_NAMES

ANYWHERE = "United States"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, r"^[\s\u00a0]+|[\s\u00a0]+$", "")


def location_list(location: Column) -> Column:
    parts = F.transform(F.split(location, ";"), strip)
    return F.coalesce(F.filter(parts, lambda p: p != ""), F.array().cast("array<string>"))


def primary(location: Column, parts: Column) -> Column:
    """What is shown first: the first of several, the text itself, or the whole country."""
    shown = F.when(F.coalesce(location, F.lit("")) == "", F.lit(ANYWHERE)).otherwise(location)
    return F.when(F.size(parts) > 1, F.get(parts, F.lit(0))).otherwise(shown)


def overflow(parts: Column) -> Column:
    return F.greatest(F.lit(0), F.size(parts) - 1)


def text_map(pairs: dict[str, str]) -> Column:
    """A constant map, written as one expression."""
    return F.expr("map(" + ", ".join(f"'{k}', '{v}'" for k, v in pairs.items()) + ")")


def state_map() -> Column:
    return text_map(STATE_NAMES)


def state_name(code: Column, names: Column | None = None, default: Column | None = None) -> Column:
    """Display name of a state code, or a fallback (the code itself unless given)."""
    names = state_map() if names is None else names
    found = F.try_element_at(names, code)
    return F.coalesce(found, code if default is None else default)
