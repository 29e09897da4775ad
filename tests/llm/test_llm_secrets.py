from __future__ import annotations

import hashlib
import random
import re
import string

import public_tokenizers
import pytest
from conftest import odd_rows

from orebed.llm import secret_tokens

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERNS = {  # as the contract states them; failing matches are dropped afterwards
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE), lambda m: len(m[2]) >= 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    "hex": (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
}
KINDS = list(PATTERNS)


def by_hand(text):
    found = [(m.start(), KINDS.index(k), m.end()) for k, (p, ok) in PATTERNS.items() for m in p.finditer(text) if ok(m)]
    return sorted(found)


def test_base_spans_match_the_patterns():
    rng = random.Random(4)
    parts = ["password", "Token", "api_key", "APIKEY", "secret", "=", ":", " ", '"', "'", "AKIA", "ABCD1234", "f00d", "deadbeef" * 3, "é", "\n", "x", "12345678", "Passwd", "ſecret", "toKen"]
    for _ in range(20000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert secret_tokens.base_spans(text) == by_hand(text), text


@pytest.mark.parametrize(
    ("run", "random_string"),
    [
        ("Zx8Qp2Lm9Rt4Vw7Ky1Bn5", True),
        ("ghp_1a2B3c4D5e6F7g8H9i0JkLmNoPqRsTuV", True),
        ("d41d8cd98f00b204e9800998ecf8427e", False),  # a digest's length
        ("123e4567-e89b-12d3-a456-426614174000", False),
        ("some_long_identifier_name_2", False),
        ("internationalization", False),
        ("getUserAccountDetailsFromRequestContext", False),
        ("Donaudampfschifffahrtsgesellschaft", False),
        ("build-2021-04-03-12-30-00-07", False),
        ("12345678901234567890", False),
    ],
)
def test_random_strings(run, random_string):
    assert secret_tokens.is_random(run, secret_tokens.ranks(RANKS)) is random_string


@pytest.mark.parametrize("alphabet", [string.ascii_letters, string.ascii_uppercase, string.ascii_lowercase])
def test_random_letters_are_marked(alphabet):
    rng = random.Random(11)
    encoding = secret_tokens.ranks(RANKS)
    keys = ["".join(rng.choice(alphabet) for _ in range(40)) for _ in range(500)]
    assert sum(secret_tokens.is_random(k, encoding) for k in keys) >= 490  # a few of lower case alone come apart into long tokens


def test_rest_of_a_run_that_a_base_span_covers_in_part():
    encoding = secret_tokens.ranks(RANKS)
    digits, tail = "0123456789abcdef" * 2, "Zx8Qp2Lm9Rt4Vw7Ky1Bn5GhJkQ"
    spans = lambda text: secret_tokens.joined(secret_tokens.all_spans(text, encoding)[1])
    assert spans(f"k {digits}{tail}") == "hex:2:34,random:34:60"
    assert spans(f"k {digits}Zx8Qp") == "hex:2:34,random:34:39"
    assert spans(f"sha256={digits}") == "hex:7:39"  # a name before the digits is no key
    assert spans(f"{tail}{digits}") == "random:0:26,hex:26:58"
    assert spans(f"my_password={tail}") == "assign:3:38"


def by_letters(text, encoding):
    """The random spans once more, by a mark per character and every cut of the text."""
    base = by_hand(text)
    covered = [any(a <= i < b for a, _, b in base) for i in range(len(text))]
    key, found = re.compile(r"[A-Za-z0-9+/_=-]"), []
    i = 0
    while i < len(text):
        j = i
        while j < len(text) and key.match(text[j]):
            j += 1
        if j - i >= 20:
            whole = secret_tokens.is_random(text[i:j], encoding)
            at = i
            while at < j:
                to = at
                while to < j and covered[to] == covered[at]:
                    to += 1
                if not covered[at]:
                    inside = [(a, b) for a, k, b in base if k and i <= a and b <= j]
                    goes_on = any((b == at and text[at].isalnum()) or (a == to and text[to - 1].isalnum()) for a, b in inside)
                    if (whole and (goes_on or (at, to) == (i, j))) or secret_tokens.is_random(text[at:to], encoding):
                        found.append((at, 3, to))
                at = to
        i = max(j, i + 1)
    return sorted(base + found)


def test_random_spans_match_brute_force():
    rng, encoding = random.Random(5), secret_tokens.ranks(RANKS)
    parts = ["password=", "token:", "AKIA", "ABCD1234EFGH5678", "deadbeef01" * 3, "Zx8Qp2Lm9Rt4Vw7Ky1", "qWkZrTpLmNvXcJhG", "word", "_", "-", "=", " ", ".", "é", "internationalization", "2021-04-03", "\n"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        assert secret_tokens.all_spans(text, encoding)[1] == by_letters(text, encoding), text


def test_scan_of_odd_rows(odd, empty):
    rows = secret_tokens.scan(odd, RANKS).collect()
    assert len(rows) == len(odd_rows())
    for r in rows:
        if r["doc_id"] == 13 and r["n_assign"]:
            assert (r["n_assign"], r["n_access"], r["n_hex"]) == (1, 0, 1)
            assert r["spans"] == "assign:0:49,hex:9:49,random:59:80"
            assert r["base_sha256"] == hashlib.sha256(b"assign:0:49,hex:9:49").hexdigest()
        else:
            assert r["spans"] == "" and r["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert secret_tokens.scan(empty, RANKS).count() == 0


def test_redaction(odd, empty):
    clean = secret_tokens.without_secrets(odd.withColumn("n_chars", odd["doc_id"].cast("int")), RANKS)
    texts = {(r["doc_id"], r["text"], r["n_chars"]) for r in clean.where("doc_id in (1, 2, 13, 14)").collect()}
    marked = '[secret]" and key [secret]'
    assert {(1, None, None), (2, "", 0), (14, "word", 4), (13, marked, len(marked))} <= texts
    assert clean.count() == len(odd_rows()) and secret_tokens.without_secrets(empty, RANKS).count() == 0
