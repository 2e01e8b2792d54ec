import random

import pytest

from riboscan.llm.pseudonyms import Pseudonyms, luhn


@pytest.mark.parametrize(
    ("text", "value", "kind"),
    [
        ("DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX", "DE89 3704 0044 0532 0130 00", "iban"),
        ("DE89370400440532013000 I owe", "DE89370400440532013000", "iban"),
        ("to GB82 WEST 1234 5698 7654 32 UNTIL 5", "GB82 WEST 1234 5698 7654 32", "iban"),
        ("4111 1111 1111 1111 05/27", "4111 1111 1111 1111", "card"),
        ("4111111111111111 123", "4111111111111111", "card"),
        ("4111-1111-1111-1111 05 27, x", "4111-1111-1111-1111", "card"),
        ("no 123 4111 1111 1111 1111.", "4111 1111 1111 1111", "card"),
        ("le 31/12/1999.", "31/12/1999", "date"),
        ("el 13/01/2020", "13/01/2020", "date"),
    ],
)
def test_values_with_neighbours(text, value, kind):
    p = Pseudonyms(b"key")
    out, kinds = p.replace(text)
    before, after = text.split(value)
    assert kinds == [kind] and value not in out and out.startswith(before) and out.endswith(after) and len(out) == len(text)
    assert p.replace(out, back=True)[0] == text
    assert out == before + p.replace(value)[0] + after  # equal values get equal pseudonyms


def test_invalid_values_stay_with_neighbours():
    for text in ("DE88 3704 0044 0532 0130 00 BIC", "DE893704004405320130", "32/12/1999", "31/13/1999", "30/02/2020", "4111111111111111123", "4111 1111 1111 1112 05/27"):
        assert Pseudonyms(b"key").replace(text) == (text, []), text


def test_digits_behind_cards_can_be_undone():
    rng, p = random.Random(1), Pseudonyms(b"key")
    for i in range(300):
        body = str(rng.randrange(10**14, 10**15))
        text = f"{body}{luhn(body)} {rng.randrange(1000):0{2 + i % 2}d}"
        out, kinds = p.replace(text)
        assert kinds == ["card"] and out[:16] != text[:16] and p.replace(out, back=True)[0] == text
    for day in range(13, 32):
        text = f"{day}/01/2001"
        out, kinds = p.replace(text)
        assert kinds == ["date"] and int(out[:2]) > 12 and p.replace(out, back=True)[0] == text
