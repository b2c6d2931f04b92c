"""Text columns: accent folding, tokens, slugs and search text."""

from __future__ import annotations

import re
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

_KEPT = re.compile(r"[a-z0-9+#]")
_MARKS = r"[\u0300-\u036f]"
# What separates words in lower-case text: anything but letters, digits, + and #. Stated by
# a named class, since a class of several ranges makes Java's matcher slow on many threads.
NON_WORD = r"[^\p{Alnum}+#]+"


def _plain(char: str) -> str:
    """What one lower-case character leaves behind: its letters, blanks where words split."""
    parts = unicodedata.normalize("NFKD", char)
    letters = (p for p in parts if not 0x300 <= ord(p) <= 0x36F)
    return "".join(p if _KEPT.match(p) else " " for p in letters)


def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """Single-letter folds for ``translate`` and the signs that spell several letters.

    The rule: a non-ASCII character that is its own lower case and leaves a letter behind.
    What leaves none (the trade mark sign folds to capitals) separates words as it is.
    """
    source, target, spelled = [], [], {}
    for code in range(0x00A0, sys.maxunicode + 1):
        char = chr(code)
        if not unicodedata.decomposition(char) or char.lower() != char:
            continue
        plain = _plain(char)
        if plain.strip():
            if len(plain) == 1:
                source.append(char)
                target.append(plain)
            else:
                spelled[char] = plain
    return "".join(source), "".join(target), spelled


_FROM, _TO, _SPELLED = _fold_tables()


def _near(chars: list[str], gap: int = 64) -> str:
    """A character class of a few ranges that covers the given characters."""
    ranges: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if ranges and code - ranges[-1][1] <= gap:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges) + "]"


#: Only a text with one of these is spelled out letter by letter; one scan with a few ranges tells.
_MAYBE_RARE = _near(list(_SPELLED))


def fold(text: Column) -> Column:
    """Lower case without accents. Plain ASCII text skips the character tables."""
    low = F.lower(text)
    wide = F.translate(F.regexp_replace(low, _MARKS, ""), _FROM, _TO)
    signs = F.create_map(*[F.lit(x) for pair in _SPELLED.items() for x in pair])
    letter = lambda c: F.when(c > "\x7f", F.coalesce(F.try_element_at(signs, c), c)).otherwise(c)
    spelled = F.array_join(F.transform(F.split(wide, ""), letter), "")
    folded = F.when(wide.rlike(_MAYBE_RARE), spelled).otherwise(wide)
    return F.when(low.rlike("[^\\x00-\\x7f]"), folded).otherwise(low)


def word_text(text: Column) -> Column:
    """The words of a text joined by one blank, with a leading blank."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(fold(text), NON_WORD, " ")))


def words(text: Column) -> Column:
    """The words of a text. ``+`` and ``#`` are letters, so C# and c++ stay whole."""
    return F.array_remove(F.split(fold(text), NON_WORD), "")


def query_words(query: str) -> list[str]:
    """The words of a query known when the plan is built."""
    low = "".join(
        c for c in unicodedata.normalize("NFKD", query.lower()) if not 0x300 <= ord(c) <= 0x36F
    )
    return [w for w in re.split("[^a-z0-9+#]+", low) if w]


def slug(name: Column) -> Column:
    low = F.replace(F.lower(name), F.lit("&"), F.lit("and"))
    return F.regexp_replace(F.regexp_replace(low, r"[^\p{Alnum}]+", "-"), "^-|-$", "")


def title_text(title: Column) -> Column:
    """Words of a title with a blank at both ends; an ampersand reads as ``and``.

    The rule patterns match whole words by the blanks around them.
    """
    spelled = F.replace(title, F.lit("&"), F.lit(" and "))
    return F.concat(word_text(spelled), F.lit(" "))


def ci(text: Column) -> Column:
    """Sort and compare key that ignores case and accents."""
    return F.collate(text, "UNICODE_CI_AI")
