"""Cards and accounts with more groups before or after them."""

from __future__ import annotations

import random
import re
from datetime import date

import pytest

from sediment.llm import pseudonyms

KEY = b"a key"


@pytest.mark.parametrize(
    "text, kind, value",
    [
        ("card 4111 1111 1111 1111 12/27", "card", "4111 1111 1111 1111"),
        ("4111111111111111 05", "card", "4111111111111111"),
        ("4111-1111-1111-1111 123, end", "card", "4111-1111-1111-1111"),
        ("order 12 4111111111111111", "card", "4111111111111111"),
        ("7 7 4111 1111 1111 1111 9 9 9 9 9", "card", "4111 1111 1111 1111"),
        ("GB82 WEST 1234 5698 7654 32 BIC ABCDEF", "bank", "GB82 WEST 1234 5698 7654 32"),
        ("GB82WEST12345698765432 BIC", "bank", "GB82WEST12345698765432"),
        ("AB12 DE89 3704 0044 0532 0130 00 X1", "bank", "DE89 3704 0044 0532 0130 00"),
    ],
)
def test_values_among_other_groups(text, kind, value):
    new, found = pseudonyms.replaced(text, KEY)
    assert found == {kind: [value]} and value not in new
    begin = text.index(value)
    assert new[:begin] == text[:begin] and new[begin + len(value) :] == text[begin + len(value) :]
    assert new[begin : begin + len(value)] == pseudonyms.replaced(value, KEY)[0]
    assert pseudonyms.replaced(new, KEY, back=True)[0] == text


def test_the_way_back_with_digits_after_a_card():
    rng = random.Random(4)
    for n in range(150):
        body = str(rng.randrange(10**14, 10**15))
        card = body + pseudonyms.checked(body)
        text = f"{card} {rng.randrange(10 ** (1 + n % 3)):0{1 + n % 3}}"
        new, found = pseudonyms.replaced(text, KEY)
        assert found["card"] and card not in new
        assert pseudonyms.replaced(new, KEY, back=True)[0] == text


def test_groups_without_a_value_stay():
    same = "1234 5678 9012 3456 78, GB82 WEST 1234 5698 7654 33 BIC ABCDEF"
    assert pseudonyms.replaced(same, KEY) == (same, {})


@pytest.mark.parametrize(
    "text, kind, kept",
    [
        ("27/12/1984", "day", r"(1[3-9]|2\d|3[01])/(0[1-9]|1[0-2])/\d{4}"),
        ("12/27/1984", "day", r"(0[1-9]|1[0-2])/[0-3]\d/\d{4}"),
        ("1/2/2024", "day", r"[1-9]/[1-9]/\d{4}"),
        ("31.1.2020", "day", r"[1-3]\d\.[1-9]\.\d{4}"),
        ("2024-1-19", "day", r"\d{4}-[1-9]-[1-3]\d"),
        ("+49 (0)30 1234567", "phone", r"\+49 \(0\)\d\d \d{7}"),
        ("0f" * 300, "secret", r"[0-9a-f]{600}"),
        ("0" * 128 + "F1" * 64, "secret", r"[0-9]{128}[0-9A-F]{128}"),
        ("token=" + "aB3xyz" * 60, "assigned", r"token=[a-zA-Z0-9]{360}"),
    ],
)
def test_formats(text, kind, kept):
    new, found = pseudonyms.replaced(text, KEY)
    assert found == {kind: [text]} and new != text and re.fullmatch(kept, new)
    assert pseudonyms.replaced(new, KEY, back=True)[0] == text


def test_dates_go_back_in_every_form():
    rng = random.Random(3)
    for _ in range(500):
        d = date.fromordinal(rng.randrange(pseudonyms.FIRST_DAY, pseudonyms.LAST_DAY + 1))
        forms = [f"{d.day}/{d.month}/{d.year}", f"{d.month:02}/{d.day:02}/{d.year}", f"{d.day:02}/{d.month:02}/{d.year}"]
        for text in [*forms, f"{d.day}.{d.month}.{d.year}", f"{d.year}-{d.month}-{d.day:02}", d.isoformat()]:
            new = pseudonyms.replaced(text, KEY)[0]
            assert len(new) == len(text) and pseudonyms.replaced(new, KEY, back=True)[0] == text
