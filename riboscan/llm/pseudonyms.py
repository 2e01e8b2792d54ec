"""Format-preserving pseudonyms of personal numbers, dates and addresses.

A found value is validated for its kind (check sums, ranges, calendar), taken
as a number of its format's domain, and permuted there by a keyed Feistel
network; walking the cycle keeps results valid. Equal values get equal
pseudonyms in every document, and the key's holder can undo them.
"""

from __future__ import annotations

import datetime
import hashlib
import hmac
import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riboscan.llm.core import free_name, table
from riboscan.llm.textkit import slices, text_bytes

ROUNDS = 8
#: Letters and digits around a number would make it part of something else.
PATTERN = re.compile(
    r"(?<![\w.])(?P<iban>[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30})(?!\w)"
    r"|(?<![\w.])(?P<ip>(?:\d{1,3}\.){3}\d{1,3})(?![\w]|\.\d)"
    r"|(?<![\w-])(?P<date>\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\w-])"
    r"|(?<![\w-])(?P<ssn>\d{3}-\d{2}-\d{4})(?![\w-])"
    r"|(?<!\w)(?P<phone>\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\w)"
    r"|(?<![\w-])(?P<card>\d(?:[ -]?\d){12,18})(?![\w-])"
)
#: What stands at an e-mail address's @ and behind it; before it stand letters, digits and LOCAL.
DOMAIN, LOCAL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), "_.%+-"
#: Letters and digits of an IBAN by country; other countries' are taken as they stand.
IBAN_SIZE = {
    x[:2]: int(x[2:])
    for x in "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30".split()
}
KINDS = ("email", *PATTERN.groupindex)
_FIRST, _LAST = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


class Permutation:
    """A keyed permutation of range(size): an alternating Feistel network over two factors, walked until it is in range and ``valid``."""

    def __init__(self, key: bytes, tweak: str, size: int, valid: Callable[[int], bool] = lambda x: True):
        self.size, self.valid = size, valid
        self.a = max(1, math.isqrt(max(0, size - 1)) + 1)
        self.b = -(-size // self.a)
        self.keys = [hmac.digest(key, f"{tweak}|{size}|{i}".encode(), "sha256") for i in range(ROUNDS)]

    def _f(self, i: int, x: int) -> int:
        return int.from_bytes(hashlib.blake2b(x.to_bytes(64, "big"), key=self.keys[i], digest_size=32).digest(), "big")

    def _once(self, x: int, back: bool) -> int:
        left, right = divmod(x, self.a)  # left < b, right < a
        m, n = self.b, self.a
        if not back:
            for i in range(ROUNDS):
                left, right, m, n = right, (left + self._f(i, right)) % m, n, m
        else:
            for i in reversed(range(ROUNDS)):
                left, right, m, n = (right - self._f(i, left)) % n, left, n, m
        return left * self.a + right

    def __call__(self, x: int, back: bool = False) -> int:
        while True:
            x = self._once(x, back)
            if x < self.size and self.valid(x):
                return x


def luhn(digits: str) -> int:
    """The check digit that follows ``digits``."""
    total = sum(sum(divmod(int(d) * 2, 10)) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(digits)))
    return -total % 10


def _iban_check(country: str, rest: str) -> int:
    return 98 - int("".join(str(int(c, 36)) for c in f"{rest}{country}00")) % 97


def _refill(shape: str, symbols: str) -> str:
    """``symbols`` in the places of the letters and digits of ``shape``."""
    it = iter(symbols)
    return "".join(next(it) if c.isalnum() else c for c in shape)


def _ends(kind: str, s: str) -> list[int]:
    """Where a value may end in a match: an IBAN after its country's number of letters and digits, a card at any gap, others at the end."""
    if kind == "iban" and s[:2] in IBAN_SIZE:
        places = [i for i, c in enumerate(s, 1) if c != " "][: IBAN_SIZE[s[:2]]]
        whole = len(places) == IBAN_SIZE[s[:2]] and not s[places[-1] : places[-1] + 1].isalnum()
        return places[-1:] if whole else []
    gaps = [i for i, c in enumerate(s) if not c.isdigit() and i >= 13] if kind == "card" else []
    return [len(s), *[i for i in reversed(gaps) if sum(c.isdigit() for c in s[:i]) >= 13]]


class Pseudonyms:
    def __init__(self, key: bytes):
        self.key = key
        self.made: dict[tuple, Permutation] = {}

    def _permute(self, tweak: str, size: int, x: int, back: bool, valid: Callable[[int], bool] = lambda x: True) -> int:
        p = self.made.get((tweak, size))
        if p is None:
            if len(self.made) > 10_000:
                self.made.clear()
            p = self.made[tweak, size] = Permutation(self.key, tweak, size, valid)
        return p(x, back)

    def _mixed(self, kind: str, text: str, back: bool) -> str:
        """Letters and digits of ``text`` as one number in mixed radix; case and other characters stay."""
        radix = [10 if c in "0123456789" else 26 if c.isascii() and c.isalpha() else 0 for c in text]
        x, size = 0, 1
        for c, r in zip(text, radix, strict=True):
            if r:
                x, size = x * r + (int(c) if r == 10 else ord(c.lower()) - 97), size * r
        if size == 1:
            return text
        x = self._permute(f"{kind}:{''.join('d' if r == 10 else 'a' if r else c for c, r in zip(text, radix, strict=True))}", size, x, back)
        out = list(text)
        for i in reversed(range(len(text))):
            if r := radix[i]:
                x, d = divmod(x, r)
                out[i] = str(d) if r == 10 else chr(97 + d) if text[i].islower() else chr(65 + d)
        return "".join(out)

    def email(self, s: str, back: bool) -> str | None:
        local, _, domain = s.partition("@")
        parts = local[:60]  # numbers of up to 512 bits; a longer rest is permuted apart
        rest = [local[i : i + 60] for i in range(60, len(local), 60)]
        return "".join(self._mixed("email", p, back) for p in [parts, *rest]) + "@" + domain

    def ip(self, s: str, back: bool) -> str | None:
        parts = [int(x) for x in s.split(".")]
        if max(parts) > 255 or any(x != str(int(x)) for x in s.split(".")):
            return None
        x = self._permute("ip", 2**32, sum(p << 24 - 8 * i for i, p in enumerate(parts)), back)
        return ".".join(str(x >> 24 - 8 * i & 255) for i in range(4))

    def date(self, s: str, back: bool) -> str | None:
        form = "%Y-%m-%d" if s[4] == "-" else "%d.%m.%Y" if s[2] == "." else "%m/%d/%Y"
        if form == "%m/%d/%Y" and int(s[3:5]) <= 12 < int(s[:2]):  # no month/day
            form = "%d/%m/%Y"
        try:
            day = datetime.datetime.strptime(s, form).date()
        except ValueError:
            return None
        if not _FIRST <= day.toordinal() <= _LAST:
            return None
        # days after the 12th among themselves: a day/month pseudonym stays one, and a day has one pseudonym in all formats
        late = day.day > 12
        same = lambda x: (datetime.date.fromordinal(_FIRST + x).day > 12) == late
        x = self._permute(f"date:{late}", _LAST - _FIRST + 1, day.toordinal() - _FIRST, back, same)
        return datetime.date.fromordinal(_FIRST + x).strftime(form)

    def ssn(self, s: str, back: bool) -> str | None:
        real = lambda x: 0 < x // 10**6 < 900 and x // 10**6 != 666 and x // 10**4 % 100 > 0 and x % 10**4 > 0
        x = int(s.replace("-", ""))
        if not real(x):
            return None
        return _refill(s, f"{self._permute('ssn', 10**9, x, back, real):09d}")

    def phone(self, s: str, back: bool) -> str | None:
        code, rest = re.match(r"(\+\d{1,3}(?=[ .(-]))?(.*)", s, re.S).groups()
        digits = re.sub(r"\D", "", rest)
        if not 7 <= len(digits) <= 15:
            return None
        lead = digits[0] != "0"
        valid = (lambda x, least=10 ** (len(digits) - 1): x >= least) if lead else (lambda x, most=10 ** (len(digits) - 1): x < most)
        return (code or "") + _refill(rest, f"{self._permute(f'phone:{lead}', 10 ** len(digits), int(digits), back, valid):0{len(digits)}d}")

    def card(self, s: str, back: bool) -> str | None:
        digits = re.sub(r"\D", "", s)
        if digits[0] == "0" or luhn(digits[:-1]) != int(digits[-1]):
            return None
        n, after = len(digits) - 1, luhn(digits)
        # the digit that could follow stays, so whether the card with digits behind it is valid too doesn't change
        same = lambda x: x >= 10 ** (n - 1) and luhn(f"{x}{luhn(str(x))}") == after
        body = str(self._permute(f"card:{after}", 10**n, int(digits[:-1]), back, same))
        return _refill(s, body + str(luhn(body)))

    def iban(self, s: str, back: bool) -> str | None:
        plain = s.replace(" ", "")
        if _iban_check(plain[:2], plain[4:]) != int(plain[2:4]):
            return None
        rest = self._mixed("iban", plain[4:], back)
        return _refill(s, f"{plain[:2]}{_iban_check(plain[:2], rest):02d}{rest}")

    def _address(self, text: str, at: int, sign: int) -> tuple[int, int, int] | None:
        """(start, end, place of @) of the first e-mail address from ``at`` on whose @ isn't before ``sign``."""
        while (sign := text.find("@", sign)) >= 0:
            if m := DOMAIN.match(text, sign):
                start = sign
                while start > at and (text[start - 1].isalnum() or text[start - 1] in LOCAL):
                    start -= 1
                if start < sign:
                    return start, m.end(), sign
            sign += 1
        return None

    def _value(self, m: re.Match, back: bool) -> tuple[str, int] | None:
        """The pseudonym of a match and how much of it that replaces; None if nothing in it is valid from its start on."""
        for end in _ends(m.lastgroup, m[0]):
            value = m[0][:end]
            out = getattr(self, m.lastgroup)(value, back)
            if out is None and m.lastgroup == "phone" and len(re.sub(r"\D", "", value)) >= 13:
                out = self.card(value, back)
            if out is not None:
                return out, end
        return None

    def replace(self, text: str, back: bool = False) -> tuple[str, list[str]]:
        """The text with every valid value replaced, and the kinds replaced, in order.

        An address's front is looked for from its @ backwards, and every other
        kind is bounded in length, so the work grows with the text's length.
        """
        kinds, parts, at, done = [], [], 0, 0
        mail, m = self._address(text, 0, 0), PATTERN.search(text)
        while mail or m:
            if mail and (m is None or mail[0] <= m.start()):
                start, at, _ = mail
                parts += [text[done:start], self.email(text[start:at], back)]
                kinds.append("email")
                done = at
            elif found := self._value(m, back):
                out, size = found
                parts += [text[done : m.start()], out]
                kinds.append(m.lastgroup)
                at = done = m.start() + size
            else:
                at = m.start() + 1  # where nothing is valid, the search goes on inside the match
            if mail and mail[0] < at:
                mail = self._address(text, at, max(at, mail[2]))
            if m and m.start() < at:
                m = PATTERN.search(text, at)
        return "".join([*parts, text[done:]]), kinds


def pseudonymise(docs: DataFrame, key: bytes, back: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in ``text``, ``n_chars`` (if there is one) following it, and a last column ``_kinds``: the kinds replaced, in order.

    Where ``docs`` has a column ``_kinds`` of its own, the last one's name gets
    underscores before it. Only valid values change; all else in a text stays as it is. ``back`` undoes
    it with the same key. Null and empty texts stay; repeated rows get the same
    result; other columns pass through.
    """
    columns = docs.columns
    at = columns.index("text")
    found = free_name(columns, "_kinds")
    schema = T.StructType([*docs.schema.fields, T.StructField(found, T.ArrayType(T.StringType()))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Pseudonyms(key)
        for batch in batches:
            data, off = text_bytes(batch.column(at))
            # only texts with a digit or an @ can hold a value
            may: list[int] = []
            for a, b in slices(off):
                part = data[off[a] : off[b]]
                at_sign = np.flatnonzero(((part >= 48) & (part <= 57)) | (part == 64)) + off[a]
                may += (a + np.flatnonzero(np.diff(np.searchsorted(at_sign, off[a : b + 1])))).tolist()
            arrays, kinds = list(batch.columns), [[] for _ in range(batch.num_rows)]
            changed: dict[int, str] = {}
            for i in may:
                text, kinds[i] = p.replace(arrays[at][i].as_py(), back)
                if kinds[i]:
                    changed[i] = text
            if changed:
                texts = arrays[at].to_pylist()
                sizes = arrays[columns.index("n_chars")].to_pylist() if "n_chars" in columns else None
                for i, text in changed.items():
                    texts[i] = text
                    if sizes:
                        sizes[i] = len(text)
                arrays[at] = pa.array(texts, arrays[at].type)
                if sizes:
                    k = columns.index("n_chars")
                    arrays[k] = pa.array(sizes, arrays[k].type)
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(kinds, pa.list_(pa.string()))], names=[*columns, found])

    return docs.mapInArrow(scan, schema)


def op10_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, text, n_found and n_<kind> of each document; the key is this query's own."""
    out = pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), b"pseudonym key of the query")
    count = lambda kind: F.size(F.filter("_kinds", lambda x: x == kind)).cast("long").alias(f"n_{kind}")
    return out.select("doc_id", "text", F.size("_kinds").cast("long").alias("n_found"), *[count(k) for k in KINDS])
