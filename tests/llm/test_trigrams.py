"""Trigram queries derived from patterns, and the secrets found through them."""

import random
import re
import string

import pytest

from eddy.llm import secrets
from eddy.llm.trigrams import trigram_query

PATTERNS = [  # none of them is a rule
    (r"abcd", [["abc", "bcd"]]), (r"ABCD|xyz", [["abc", "bcd"], ["xyz"]]), (r"ab[cd]e", [["abc", "bce"], ["abd", "bde"]]),
    (r"abc\d+def", [["abc", "def"]]), (r"(?:abc)+d", [["abc", "bcd"]]), (r"(?:abc)*d", []), (r"abc?d", [["abc", "bcd"], ["abd"]]), (r"abcx?d", [["abc", "bcd"], ["abc", "bcx", "cxd"]]),
    (r"a.c", []), (r"(?:ab|cd){2}", [["aba", "bab"], ["abc", "bcd"], ["cda", "dab"], ["cdc", "dcd"]]), (r"[a-z]{5}", []), (r"[^a]bcd", [["bcd"]]),
    (r"(key|pass)(?:word)?=\w+", None), (r"x{2,5}y", None), (r"(?=abc)\w+def", [["def"]]), (r"[a-f]{0,2}foo|bar[x-z]{3,}", None),
    (r"é+abc", [["abc"]]), (r"(?:a|b|c|d|e)(?:a|b|c|d|e)(?:a|b|c|d|e)(?:a|b|c|d|e)", None), (r"(?i:Foo)-{2,}(?:BAR)??baz", None), (r"\bab(?P<q>c|dd)e$", None)]


@pytest.mark.parametrize("pattern,want", PATTERNS)
def test_query_of_a_pattern(pattern, want):
    got = trigram_query(pattern)
    if want is not None:
        assert got == want
    r = random.Random(len(pattern))
    for _ in range(300):
        text = "".join(r.choice(["a", "b", "c", "d", "e", "abc", "def", "foo", "xyz", "é", "key=", "xxy", "-", "baz"]) for _ in range(r.randrange(12)))
        for m in re.finditer(pattern, text):
            assert not got or any(all(t in text.lower() for t in ts) for ts in got)


def test_query_of_random_patterns():
    """Patterns made together with a text that they match."""
    r = random.Random(3)

    def made(depth):
        if depth == 0:
            letter = r.choice("abc")
            return r.choice([(letter, lambda: letter), ("b" + letter, lambda: "b" + letter), ("[ab]", lambda: r.choice("ab")),
                             ("[a-z]", lambda: r.choice("pqr")), (".", lambda: "!"), ("(?i:" + letter + ")", lambda: letter.upper())])
        (one, text), (two, other), kind = made(depth - 1), made(depth - 1), r.randrange(4)
        if kind == 0:
            return one + two, lambda: text() + other()
        if kind == 1:
            return f"(?:{one}|{two})", lambda: r.choice([text, other])()
        low = r.randrange(3)
        high = low + r.randrange(1, 3)
        mark = "+" if kind == 2 else f"{{{low},{high}}}"
        low, high = (1, 3) if kind == 2 else (low, high)
        return f"(?:{one}){mark}{two}", lambda: "".join(text() for _ in range(r.randint(low, high))) + other()

    with_query = 0
    for _ in range(300):
        pattern, text = made(4)
        got = trigram_query(pattern)
        with_query += bool(got)
        for t in {text() for _ in range(20)}:
            assert not got or any(all(x in t.lower() for x in ts) for ts in got), (pattern, t)
    assert with_query > 30


def hidden(kind, r):
    letters = string.ascii_letters + string.digits
    some = lambda n: "".join(r.choice(letters) for _ in range(n))
    return {"pem": "-----BEGIN RSA PRIVATE KEY-----", "github": "ghp_" + some(36), "slack": "xoxb-" + some(12), "stripe": "sk_live_" + some(20),
            "google": "AIza" + some(35), "login": "://user:" + some(6) + "@"}[kind]


def test_further_kinds(spark):
    r = random.Random(8)
    rows = []
    for i in range(120):
        words = [r.choice(["é", "plain", "ghp_short", "a://b", "\U0001f600", "AKIA" + "Z" * 16]) for _ in range(12)]
        for kind in r.sample([x.kind for x in secrets.MORE], 2):
            words.insert(r.randrange(12), hidden(kind, r))
        rows.append((i, " ".join(words)))
    got = {x.doc_id: x for x in secrets.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        want = sorted((m.start(), k, m.end()) for k, rule in enumerate(secrets.RULES) for m in re.finditer(rule.pattern, text)
                      if len(m[rule.group]) >= rule.least)
        assert got[i].spans == ",".join(f"{secrets.RULES[k].kind}:{s}:{e}" for s, k, e in want)
        assert sum(k > 2 for _, k, _ in want) >= 2


def test_many_matches_in_one_text(spark):
    sizes = (0, 1, secrets.SPAN_BLOCK, secrets.SPAN_BLOCK + 1, 60_000)
    rows = [(n, "é " + "token=12345678 " * n) for n in sizes]
    got = secrets.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert {x.doc_id: x.n_assign for x in got} == {n: n for n in sizes}
    for x in got:
        assert x.spans == ",".join(f"assign:{2 + 15 * i}:{16 + 15 * i}" for i in range(x.doc_id))
