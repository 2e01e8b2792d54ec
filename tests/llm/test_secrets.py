import random
import re

import numpy as np
import pytest

from riboscan.llm.automaton import Automaton
from riboscan.llm.secrets import BASE, RULES, base_digest, find_secrets, op4_secret_automaton, redact_secrets, scanner


def brute(text):
    """By the regular expressions themselves."""
    out = []
    for m in re.finditer(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def scan(text):
    data = np.frombuffer(text.encode(), np.uint8)
    return scanner().scan(data, np.array([0, len(data)])).get(0, [])


def test_automaton_is_minimal_and_exact():
    a = Automaton([("a(b|c){2,3}d?", False), ("[x-z]+", True)], search=False)
    for text in ("abb", "acbcd", "abcbcb", "XyZ", "ab", "", "abbd"):
        m = max((len(x[0]) for p, f in (("a(b|c){2,3}d?", 0), ("[x-z]+", re.I)) if (x := re.match(p, text, f))), default=-1)
        assert a.longest(text.encode(), 0, len(text)) == m
    assert len(Automaton([("ab|ac|ad", False)], search=False).rows) == 4  # start, a, end, dead


def test_random_texts_match_regular_expressions():
    rng = random.Random(5)
    parts = ["password", "Token", "api_key", "apikey", "SECRET", "=", ":", " ", "'", '"', "AKIA", "ABCD1234", "deadbeef", "0123456789abcdef", "é", "ü,", "\n", ".", "longvalue123", "-", "x", "ghp_", "eyJ"]
    for _ in range(1500):
        text = "".join(rng.choices(parts, k=rng.randint(0, 60)))
        assert [s for s in scan(text) if s[1] < 3] == brute(text), text


def test_long_runs_and_pieces():
    for text in ("ab" * 5000 + "\n" + "x" * 700 + " token = '" + "Z" * 3000, "é" * 999 + "AKIA" + "Q" * 40 + ",", "f" * 20000, "word " * 3000 + "secret:" + "a.b" * 9):
        assert [s for s in scan(text) if s[1] < 3] == brute(text)


@pytest.mark.parametrize("secret", ["ghp_" + "a1" * 18, "glpat-" + "x" * 20, "xoxb-123456789012-abc", "AIza" + "b" * 35, "sk_live_" + "9z" * 10, "eyJhbGciOiJI.eyJzdWIiOiIx." + "q" * 20, "-----BEGIN RSA PRIVATE KEY-----"])
def test_added_rules(secret):
    found = scan(f"xé, {secret}, y")
    assert any(r >= len(BASE) and (a, b) == (4, 4 + len(secret)) for a, r, b in found)
    assert all(r < len(BASE) for _, r, _ in scan(f"{secret[: len(secret) // 3]} ,"))


def test_queries_on_odd_rows(spark):
    rows = [(1, None, "a", "b", None), (2, "", "a", "b", 0), (3, 'é token = "abcdefgh12"!', "a", "b", 23), (3, 'é token = "abcdefgh12"!', "a", "b", 23), (None, "AKIA" + "B" * 16, None, None, 20), (5, "x, " * 40000 + "0a" * 20, "a", "b", 120040)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, found string, n_chars long")
    got = [(r.doc_id, [tuple(x) for x in r.found]) for r in find_secrets(docs).collect()]
    assert sorted(got, key=str) == sorted([(1, []), (2, []), (3, [("assign", 2, 21)]), (3, [("assign", 2, 21)]), (None, [("access", 0, 20)]), (5, [("hex", 120000, 120040)])], key=str)
    out = {r.doc_id: r for r in redact_secrets(docs).collect()}
    assert out[3].text == 'é [assign]"!' and out[3].n_chars == 12 and out[1].text is None and out[5].text.endswith("x, [hex]")
    assert out[None].text == "[access]" and redact_secrets(docs).columns == docs.columns
    assert find_secrets(docs.limit(0)).count() == 0


def test_query_against_brute_force(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = op4_secret_automaton(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        spans = [(RULES[k].kind, a, b) for a, k, b in brute(texts[r.doc_id] or "")]
        assert r.base_sha256 == base_digest(spans)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[0] == k for s in spans) for k in ("assign", "access", "hex"))
        assert {":".join(map(str, s)) for s in spans} <= set(r.spans.split(","))
