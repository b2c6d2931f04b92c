"""Personal data by anchor expansion.

An Aho-Corasick automaton finds at-signs, address schemes and identifier cues in one pass over a text;
local parsers expand each anchor to the left and right and validate what they find. Numbers (ip, card,
phone) are anchored at their digits or plus sign.

Spans are code points, end exclusive, leftmost and non-overlapping within a kind. Beside the base kinds
the anchors give ``handle`` (an at-sign with a name right of it only), ``address`` (a web or file address
with a valid host) and ``account`` (a value after an identifier cue).

Defined results: a null text is empty; repeated rows get equal rows; other columns are never read.
"""

from __future__ import annotations

import functools
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
EXTRA_KINDS = ("handle", "address", "account")

# Schemes and identifier cues that anchor a parser.
SCHEMES = ("http://", "https://", "ftp://", "sftp://", "ssh://")
CUES = (
    "password", "passwd", "pwd", "secret", "api_key", "api-key", "apikey", "access_key", "access key",
    "auth_token", "access_token", "account number", "account no", "account id", "acct", "iban", "ssn",
    "social security number", "passport number", "passport no", "customer id", "user id", "username",
    "login", "tax id", "licence number", "license number",
)

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9.]{7,}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_HANDLE = re.compile(r"[A-Za-z0-9_][A-Za-z0-9_.-]*[A-Za-z0-9_]")
_ADDRESS = re.compile(r"[^\s<>\"'`\\^{}|]+")
_AUTHORITY = re.compile(r"(?:[^\s/?#@]*@)?(\[[0-9A-Fa-f:.]+\]|[^\s/?#:@\[\]]+)(?::[0-9]{1,5})?(?=[/?#]|\Z)")
_LABELS = re.compile(r"(?:[^\W_](?:[\w-]*[^\W_])?\.)+[^\W_]{2,}\.?\Z|[0-9]{1,3}(?:\.[0-9]{1,3}){3}\Z|localhost\Z")
_VALUE = re.compile(r"\s*(?:is\b|[:=#])\s*(?:(\")([^\"\s]+)\"|(')([^'\s]+)'|([A-Za-z0-9][A-Za-z0-9_.+/=-]*))")
_DIGIT = re.compile(r"[0-9]")
_ODD = str.maketrans("0123456789", "0246813579")


@functools.cache
def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    found.add_word("@", ("at", 1))
    for word in SCHEMES:
        for form in {word, word.upper(), word.capitalize()}:
            found.add_word(form, ("scheme", len(form)))
    for word in CUES:
        for form in {word, word.upper(), word.capitalize(), word.title()}:
            found.add_word(form, ("cue", len(form)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(map(int, digits[-2::-2].translate(_ODD)))
    return total % 10 == 0


def ips(text: str) -> list[tuple[int, int]]:
    """Four dotted numbers at a time, each at most 255."""
    out = []
    for run in _DOTTED.finditer(text):
        if run[0].count(".") < 3:
            continue
        at, start, parts = run.start(), 0, []
        for part in run[0].split("."):
            if not part:
                parts = []
            else:
                if not parts:
                    start = at
                parts.append(part.lstrip("0"))
                if len(parts) == 4:
                    if all(len(p) < 4 and int(p or 0) < 256 for p in parts):
                        out.append((start, at + len(part)))
                    parts = []
            at += len(part) + 1
    return out


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for match in _CARD.finditer(text):
        digits = match[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(match.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m[0])) <= 15]


def emails(text: str, anchors: list[int]) -> list[tuple[int, int]]:
    """Each at-sign is expanded left over the local part and right over a dotted domain."""
    out, floor = [], 0
    for at in anchors:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            out.append((start, domain.end()))
            floor = domain.end()
    return out


def handles(text: str, anchors: list[int]) -> list[tuple[int, int]]:
    out = []
    for at in anchors:
        before = text[at - 1] if at else " "
        if not (before.isalnum() or before in "._%+-@/"):
            name = _HANDLE.match(text, at + 1)
            if name and any(c.isalpha() for c in name[0]) and text[name.end() : name.end() + 1] != "@":
                out.append((at, name.end()))
    return out


def addresses(text: str, anchors: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """A scheme is expanded right to the end of the address; its host must be a valid name or number."""
    out, floor = [], 0
    for start, after in anchors:
        if start < floor or (start and text[start - 1].isalnum()):
            continue
        rest = _ADDRESS.match(text, after)
        if not rest:
            continue
        end = rest.end()
        while end > after and (text[end - 1] in ".,;:!?" or text[end - 1] == ")" and "(" not in text[after:end]):
            end -= 1
        authority = _AUTHORITY.match(text, after, end)
        if authority and (authority[1][0] == "[" or _LABELS.match(authority[1])):
            out.append((start, end))
            floor = end
    return out


def accounts(text: str, anchors: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The value that follows a cue; it holds a digit and at least four characters."""
    out, floor = [], 0
    for start, after in anchors:
        if start and (text[start - 1].isalnum()):
            continue
        value = _VALUE.match(text, after)
        if value:
            group = next(i for i in (2, 4, 5) if value[i])
            begin, end = value.span(group)
            while end > begin and text[end - 1] in ".,-/":
                end -= 1
            if begin >= floor and end - begin > 3 and _DIGIT.search(text, begin, end):
                out.append((begin, end))
                floor = end
    return out


def find(text: str | None) -> dict[str, list[tuple[int, int]]]:
    """Spans of each kind, in order."""
    text = text or ""
    at, schemes, cues = [], [], []
    for last, (kind, size) in automaton().iter(text):
        if kind == "at":
            at.append(last)
        else:
            (schemes if kind == "scheme" else cues).append((last + 1 - size, last + 1))
    numbers = bool(_DIGIT.search(text))
    return {
        "email": emails(text, at) if at else [],
        "ip": ips(text) if numbers else [],
        "card": cards(text) if numbers else [],
        "phone": phones(text) if numbers and "+" in text else [],
        "handle": handles(text, at) if at else [],
        "address": addresses(text, sorted(schemes)) if schemes else [],
        "account": accounts(text, sorted(cues)) if cues else [],
    }


def _find_batches(batches):
    kinds = BASE_KINDS + EXTRA_KINDS
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch in batches:
        spans = []
        for scalar in batch.column("text"):
            found = find(scalar.as_py())
            spans.append([{"kind": k, "start": a, "end": b} for k in kinds for a, b in found[k]])
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(spans, span)], ["id", "spans"])


def personal_spans(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) of every row: an array of kind, start, end, by kind and then start."""
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {dict(rows.dtypes)['id']}, spans array<struct<kind:string,start:bigint,end:bigint>>"
    return rows.mapInArrow(_find_batches, schema)
