import base64
import random

import pytest

from riboscan.llm.secrets import RULES, redact_secrets, scanner
from test_secrets import scan

BODY = base64.b64encode(random.Random(4).randbytes(700)).decode()
LINES = [BODY[i : i + 64] for i in range(0, len(BODY), 64)]
KEY = [i for i, r in enumerate(RULES) if r.kind == "key"][0]


def pem(label, end="\n", fields=(), last=True):
    return end.join([f"-----BEGIN {label}-----", *fields, *LINES, *([f"-----END {label}-----"] if last else [])])


KEYS = {
    "rsa": pem("RSA PRIVATE KEY"),
    "plain": pem("PRIVATE KEY", "\r\n"),
    "openssh": pem("OPENSSH PRIVATE KEY", "\n    "),
    "escaped": pem("PRIVATE KEY", "\\n"),
    "encrypted": pem("EC PRIVATE KEY", fields=["Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,0A1B", ""]),
    "pgp": pem("PGP PRIVATE KEY BLOCK", fields=["Version: GnuPG v2", "", "=aB3d"]),
    "one line": f"-----BEGIN PRIVATE KEY----- {BODY} -----END PRIVATE KEY-----",
    "no end": pem("RSA PRIVATE KEY", last=False),
    "no end, fields": pem("PGP PRIVATE KEY BLOCK", fields=["Version: 1", ""], last=False),
    "no end, escaped": pem("PRIVATE KEY", "\\n", last=False),
    "no end, one line": f"-----BEGIN PRIVATE KEY----- {BODY}",
}


@pytest.mark.parametrize("name", list(KEYS))
def test_whole_keys_are_found(name):
    text = f"é, before\n{KEYS[name]}\nAnd so on, é."
    assert [(a, b) for a, r, b in scan(text) if r == KEY] == [(10, 10 + len(KEYS[name]))]


def test_no_byte_of_a_key_stays(spark):
    texts = [f"é one\n{k}\nlast words here." for k in KEYS.values()] + ["token=" + KEYS["rsa"], KEYS["no end"] + "\n" + KEYS["pgp"] + " x", KEYS["rsa"][:300], "The line -----BEGIN PRIVATE KEY----- begins a key.\n\nMore words, é.", "x -----BEGIN PUBLIC KEY-----\nabcd"]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    out = {r.doc_id: r for r in redact_secrets(docs).collect()}
    n = len(KEYS)
    assert all(out[i].text == "é one\n[key]\nlast words here." and out[i].n_chars == 28 for i in range(n))
    assert [out[n + i].text for i in range(5)] == ["[assign]", "[key]\n[key] x", "[key]", "The line [key] begins a key.\n\nMore words, é.", texts[-1]]


def test_many_first_lines_take_little_time():
    text = "-----BEGIN RSA PRIVATE KEY-----\n" * 3000 + "a" * 100000
    assert len([1 for _, r, _ in scan(text) if r == KEY]) == 3000 and scanner() is scanner()
