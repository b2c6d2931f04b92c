"""Anchored parsers against the plain patterns, and the query against both."""

import hashlib
import random
import re

import pytest

from vacantia.llm import pii, queries

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _luhn(text):
    digits = [int(c) for c in text if c.isdigit()][::-1]
    return sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])


def brute(text):
    count = lambda m: sum(c.isdigit() for c in m[0])
    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(p) < 256 for p in m[0].split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 13 <= count(m) <= 19 and _luhn(m[0]) % 10 == 0],
        "phone": [m.span() for m in PHONE.finditer(text) if 9 <= count(m) <= 15],
    }


def test_base_kinds_equal_plain_patterns_on_random_texts():
    rng = random.Random(5)
    for alphabet in ("a@.b-1", "0123456789.", "4 -0123", "+1 ().2-", "a@b.c +1.2.3.4é"):
        for _ in range(3000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))
            found, want = pii.find(text), brute(text)
            assert {k: found[k] for k in want} == want, text


def test_long_runs_stay_linear():
    for text in ("1" * 300_000, "1." * 200_000, "a" * 300_000 + "@", "@" * 300_000, "+" * 200_000 + "1 " * 100_000):
        pii.find(text)


@pytest.mark.parametrize(
    ("text", "kind", "value"),
    [
        ("see https://user.example.com/a_(b). End", "address", "https://user.example.com/a_(b)"),
        ("HTTP://10.0.0.1:80/x!", "address", "HTTP://10.0.0.1:80/x"),
        ('api_key = "abc123def"', "account", "abc123def"),
        ("password=hunter22,", "account", "hunter22"),
        ("Account number is 12-345-678.", "account", "12-345-678"),
        ("ask @jo_smith.99 now", "handle", "@jo_smith.99"),
    ],
)
def test_anchors_expand(text, kind, value):
    assert [text[a:b] for a, b in pii.find(text)[kind]] == [value]


@pytest.mark.parametrize("text", ["https://", "http:///x", "https://-bad/", "password is set", "jo@", "a @ b", ""])
def test_invalid_boundaries(text):
    found = pii.find(text)
    assert not found["address"] and not found["account"] and not found["handle"]


def test_query_equals_brute_force(spark, folder, documents):
    rows = {r["doc_id"]: r for r in queries.QUERIES["op5_personal_data"](spark, folder).collect()}
    assert len(rows) == len(documents)
    for doc_id, text, _ in documents:
        want = brute(text or "")
        row = rows[doc_id]
        assert [row["n_email"], row["n_ip"], row["n_card"], row["n_phone"]] == [len(v) for v in want.values()]
        spelled = [f"{k}:{a}:{b}" for k, spans in want.items() for a, b in spans]
        assert row["base_sha256"] == hashlib.sha256(",".join(spelled).encode()).hexdigest()
        assert set(spelled) <= set(row["spans"].split(",")) | {""}


def test_odd_rows(spark, make):
    rows = [(1, None), (2, ""), (None, "a@b.cc"), (3, "x" * 200_000), (4, "a@b.cc"), (4, "a@b.cc")]
    out = pii.personal_spans(make(rows, extra=("spans", "id", "kind"))).collect()
    assert sorted((r["id"] or 0, len(r["spans"])) for r in out) == [(0, 1), (1, 0), (2, 0), (3, 0), (4, 1), (4, 1)]
    assert pii.personal_spans(make([])).collect() == []
