"""Format-preserving pseudonyms: validated personal values are permuted, under a key, within their format.

Emails, phone, card, account and social security numbers, addresses of machines, dates, and given
passwords, tokens and keys are recognised; where a format has check digits or ranges they must hold.
A value is turned into a number below the size of its format (the digits of a phone number, the day
of a date, the letters and digits of a mailbox). A Feistel network over that number's bits, repeated
until the result is a valid value again, permutes the valid values of a format. So equal values have
equal pseudonyms in all documents, different values have different ones, punctuation and length stay,
check digits hold, and whoever has the key can go back.

Null texts stay null; empty texts and texts without such values stay as they are. Every row is
handled on its own, so repeated rows and ids stay alike, and other columns are passed through
unchanged, whatever their names.
"""

from __future__ import annotations

import hmac
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date

import pyarrow as pa
from pyspark.sql import DataFrame

ROUNDS = 10
FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()
CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
HEX = ("0123456789abcdef",)
UPPER_HEX = ("0123456789ABCDEF",)


def round_value(key: bytes, tweak: str, number: int, half: int, bits: int) -> int:
    message = f"{tweak}/{number}/{half:x}".encode()
    out = b""
    while 8 * len(out) < bits:
        out += hmac.digest(key, message + len(out).to_bytes(2, "big"), "sha256")
    return int.from_bytes(out, "big") & ((1 << bits) - 1)


def permuted(value: int, size: int, key: bytes, tweak: str, valid: Callable[[int], bool], back: bool = False) -> int:
    """A keyed permutation of the valid numbers below ``size``; ``back`` undoes it."""
    bits = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << bits) - 1
    while True:
        left, right = value >> bits, value & mask
        if back:
            for number in reversed(range(ROUNDS)):
                left, right = right ^ round_value(key, tweak, number, left, bits), left
        else:
            for number in range(ROUNDS):
                left, right = right, left ^ round_value(key, tweak, number, right, bits)
        value = left << bits | right
        if value < size and valid(value):
            return value


def to_number(text: str, classes: tuple[str, ...]) -> tuple[int, int]:
    """The characters of the classes as one number, and how many such numbers there are."""
    value, size = 0, 1
    for c in text:
        for alphabet in classes:
            if c in alphabet:
                value, size = value * len(alphabet) + alphabet.index(c), size * len(alphabet)
                break
    return value, size


def from_number(value: int, like: str, classes: tuple[str, ...]) -> str:
    """The number in the place of those characters of ``like``; the others stay."""
    out = list(like)
    for i in range(len(like) - 1, -1, -1):
        for alphabet in classes:
            if like[i] in alphabet:
                value, at = divmod(value, len(alphabet))
                out[i] = alphabet[at]
                break
    return "".join(out)


def spelled(text: str, key: bytes, kind: str, back: bool, classes=CLASSES, valid=lambda text: True) -> str:
    """The permutation of a text's letters and digits, each within its class; equal ones link across punctuation."""
    plain = "".join(c for c in text if any(c in alphabet for alphabet in classes))
    value, size = to_number(plain, classes)
    if size < 2:
        return text
    shape = "".join(str(next(i for i, a in enumerate(classes) if c in a)) for c in plain)
    value = permuted(value, size, key, f"{kind}/{shape}", lambda n: valid(from_number(n, plain, classes)), back)
    return from_number(value, text, classes)


def digit_sum(digits: str, odd: int = 0) -> int:
    """The sum of the Luhn test; with ``odd`` as if one digit more followed."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + (i + odd) % 2)
        total += d - 9 * (d > 9)
    return total % 10


def luhn(digits: str) -> bool:
    return digit_sum(digits) == 0


def checked(body: str) -> str:
    return next(c for c in "0123456789" if luhn(body + c))


def card(text: str, key: bytes, back: bool) -> str | None:
    digits = re.sub(r"\D", "", text)
    if not 13 <= len(digits) <= 19 or digits[0] == "0" or not luhn(digits):
        return None
    # The other sum stays as well: whether the card holds together with digits after it does not change.
    other = digit_sum(digits, 1)
    body = spelled(
        digits[:-1], key, "card", back, valid=lambda d: d[0] != "0" and digit_sum(d + checked(d), 1) == other
    )
    return from_number(int(body + checked(body)), text, CLASSES[:1])


def email(text: str, key: bytes, back: bool) -> str | None:
    box, at, domain = text.rpartition("@")
    return spelled(box, key, "email/" + domain.lower(), back) + at + domain


def address(text: str, key: bytes, back: bool) -> str | None:
    parts = text.split(".")
    if any(len(p) > 1 and p[0] == "0" or int(p) > 255 for p in parts):
        return None
    value = int.from_bytes(bytes(map(int, parts)), "big")
    new = permuted(value, 1 << 32, key, "address", lambda n: True, back)
    return ".".join(map(str, new.to_bytes(4, "big")))


def day(text: str, key: bytes, back: bool) -> str | None:
    fields = [int(x) for x in re.findall(r"\d+", text)]
    year_first = len(re.match(r"\d+", text)[0]) == 4
    slashed = "/" in text and not year_first
    # With slashes the month is first, unless it cannot be; then the new one cannot be a month either.
    month_first = slashed and fields[0] <= 12
    year, month, dom = fields if year_first else (fields[2], *(fields[:2] if month_first else fields[1::-1]))
    try:
        ordinal = date(year, month, dom).toordinal()
    except ValueError:
        return None
    if not FIRST_DAY <= ordinal <= LAST_DAY:
        return None
    given = re.findall(r"\d+", text)
    marks = re.findall(r"\D", text)
    padded = all(len(f) > 1 for f in given)

    def written(n: int) -> list[str]:
        to = date.fromordinal(n + FIRST_DAY)
        ordered = (to.year, to.month, to.day) if year_first else (to.month, to.day) if month_first else (to.day, to.month)
        ordered = ordered if year_first else (*ordered, to.year)
        return [f"{new:0{len(old)}}" for new, old in zip(ordered, given, strict=True)]

    def alike(n: int) -> bool:
        """Fields without a leading zero keep their length, and a day that shows it is one stays so."""
        fields = written(n)
        if slashed and not month_first and int(fields[0]) <= 12:
            return False
        if padded:
            return True
        return all(len(f) == len(g) and (f[0] == "0") == (g[0] == "0") for f, g in zip(fields, given, strict=True))

    kind = "day" if month_first or not slashed else "day first"
    tweak = kind if padded else kind + "/" + ".".join(f"{len(f)}{f[0] == '0':d}" for f in given)
    a, b, c = written(permuted(ordinal - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, key, tweak, alike, back))
    return a + marks[0] + b + marks[1] + c


def phone(text: str, key: bytes, back: bool) -> str | None:
    # The zero in brackets is dialled at home only; it is no part of the number.
    country = re.match(r"\+\d{1,3}(?:[ .-]?\(0\)|(?=[ .-]))|", text)[0]
    if not 7 <= len(re.sub(r"\D", "", text[len(country) :])) <= 12:
        return None
    return country + spelled(text[len(country) :], key, "phone", back)


def social(text: str, key: bytes, back: bool) -> str | None:
    def valid(digits: str) -> bool:
        return digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"

    return spelled(text, key, "social", back, valid=valid) if valid(re.sub(r"\D", "", text)) else None


#: Letters and digits of an account number by country.
BANK_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
        21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}


def bank_check(country: str, account: str) -> str:
    number = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{98 - int(number) % 97:02}"


def bank(text: str, key: bytes, back: bool) -> str | None:
    plain = text.replace(" ", "")
    country, check, account = plain[:2], plain[2:4], plain[4:]
    if not 11 <= len(account) <= 30 or check != bank_check(country, account):
        return None
    new = spelled(account, key, "bank/" + country, back)
    rest = iter(country + bank_check(country, new) + new)
    return "".join(c if c == " " else next(rest) for c in text)


HEXADECIMAL = re.compile("[0-9a-f]+|[0-9A-F]+")
#: Longer secrets are permuted in pieces of so many characters.
SECRET_PIECE = 128


def long_secret(text: str, key: bytes, back: bool) -> str:
    """Piece by piece; each stays of the kind it is, and so the whole does."""
    pieces = [text[i : i + SECRET_PIECE] for i in range(0, len(text), SECRET_PIECE)]
    if re.fullmatch("[0-9a-f]+", text):
        return "".join(spelled(p, key, "secret", back, HEX) for p in pieces)
    if re.fullmatch("[0-9A-F]+", text):
        return "".join(
            spelled(p, key, "secret", back, CLASSES[:1])
            if p.isdigit()
            else spelled(p, key, "secret", back, UPPER_HEX, lambda t: not t.isdigit())
            for p in pieces
        )
    return "".join(
        spelled(p, key, "secret", back)
        if HEXADECIMAL.fullmatch(p)
        else spelled(p, key, "secret", back, valid=lambda t: not HEXADECIMAL.fullmatch(t))
        for p in pieces
    )


def secret(text: str, key: bytes, back: bool) -> str | None:
    if len(text) > SECRET_PIECE:
        return long_secret(text, key, back)
    if text[:4] in ("AKIA", "ASIA"):
        return text[:4] + spelled(text[4:], key, "access", back, (CLASSES[0] + CLASSES[2],))
    if re.fullmatch("[0-9a-f]+", text):
        return spelled(text, key, "secret", back, HEX)
    if re.fullmatch("[0-9A-F]+", text):
        return spelled(text, key, "secret", back, UPPER_HEX, lambda t: not t.isdigit())
    return spelled(text, key, "secret", back, valid=lambda t: not re.fullmatch("[0-9a-f]+|[0-9A-F]+", t))


def assigned(text: str, key: bytes, back: bool) -> str | None:
    """What is given as a password, token or key; words without a digit are none."""
    value = re.search(r"[A-Za-z0-9]+\Z", text)[0]
    return text[: -len(value)] + secret(value, key, back) if any(c.isdigit() for c in value) else None


@dataclass(frozen=True)
class Kind:
    pattern: str
    replace: Callable[[str, bytes, bool], str | None]
    #: Where a run of groups goes on at a separator, a value can be some of the groups only.
    groups: str = ""


EDGE, END = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
#: In the order in which they are tried at a place.
KINDS = {
    "email": Kind(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}", email),
    "bank": Kind(EDGE + r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}" + END, bank, " "),
    "assigned": Kind(
        r"(?<![A-Za-z0-9])(?i:password|passwd|pwd|secret|token|api[_-]?key)[ \t]{0,3}[=:][ \t]{0,3}[\"']?"
        r"[A-Za-z0-9]{8,}" + END,
        assigned,
    ),
    "secret": Kind(
        EDGE + r"(?:[0-9a-f]{32,}|[0-9A-F]{32,}|(?:AKIA|ASIA)[A-Z0-9]{16})" + END, secret
    ),
    "address": Kind(r"(?<![0-9A-Za-z.])\d{1,3}(?:\.\d{1,3}){3}(?![0-9A-Za-z]|\.\d)", address),
    "day": Kind(
        EDGE + r"(?:\d{4}([-/.])\d\d?\1\d\d?|\d\d?([/.-])\d\d?\2\d{4})" + END,
        day,
    ),
    "social": Kind(EDGE + r"\d{3}-\d{2}-\d{4}" + END, social),
    "card": Kind(EDGE + r"\d(?:[ -]?\d){12,18}" + END, card, " -"),
    "phone": Kind(
        r"(?<![0-9A-Za-z+])(?:\+\d{1,3}[ .-]?(?:\(0\)[ .-]?)?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}"
        r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4})" + END,
        phone,
    ),
}
#: Cards as they are usually written, before those in other groups: digits before such a card are not its first.
USUAL_CARD = Kind(EDGE + r"(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}(?:\1\d{1,3})?)" + END, card, " -")
FIND = [
    (name, re.compile(kind.pattern), kind)
    for name, given in KINDS.items()
    for kind in ([USUAL_CARD, given] if name == "card" else [given])
]
#: A value has an @, three digits close together, 32 hexadecimal digits, or something that names it.
HINT = re.compile(r"@|\d[ .()/-]{0,3}\d[ .()/-]{0,3}\d|[0-9a-fA-F]{32}")
NAMED = re.compile(r"(?i:password|passwd|pwd|secret|token|key)[ \t]*[=:]")


def hinted(text: str) -> bool:
    """Whether the text can have a value at all."""
    if HINT.search(text) or "AKIA" in text or "ASIA" in text:
        return True
    return ("=" in text or ":" in text) and bool(NAMED.search(text))


def values(
    text: str, pattern: re.Pattern, kind: Kind, covered: bytearray, key: bytes, back: bool
) -> Iterator[tuple[int, int, str]]:
    """Start, end and pseudonym of the values of a kind, outside what is ``covered``.

    Of a run of groups the longest prefix is taken that holds and ends before a separator; of an account
    number rather that of its country's length. If none holds, the search goes on at the run's next group.
    """
    at = 0
    while m := pattern.search(text, at):
        begin, end = m.span()
        at = end
        ends = [end, *(i for i in range(end - 1, begin, -1) if text[i] in kind.groups)]
        length = BANK_LENGTHS.get(m[0][:2])
        for end in sorted(ends, key=lambda i: len(text[begin:i].replace(" ", "")) != length) if length else ends:
            if end < m.end() and not pattern.fullmatch(text, begin, end) or 1 in covered[begin:end]:
                continue
            new = kind.replace(text[begin:end], key, back)
            if new is not None:
                yield begin, end, new
                at = end
                break
        else:
            at = ends[-1] if len(ends) > 1 else at


def replaced(text: str, key: bytes, back: bool = False) -> tuple[str, dict[str, list[str]]]:
    """The text with its values permuted, and the values found by kind."""
    found: dict[str, list[str]] = {}
    if not hinted(text):
        return text, found
    taken: list[tuple[int, int, str]] = []
    covered = bytearray(len(text))
    for name, pattern, kind in FIND:
        for begin, end, new in values(text, pattern, kind, covered, key, back):
            taken.append((begin, end, new))
            covered[begin:end] = b"\x01" * (end - begin)
            found.setdefault(name, []).append(text[begin:end])
    taken.sort()
    out, at = [], 0
    for a, b, new in taken:
        out += [text[at:a], new]
        at = b
    return "".join([*out, text[at:]]), found


def pseudonymised(docs: DataFrame, key: bytes, text_col: str = "text", back: bool = False) -> DataFrame:
    """``docs`` with the values in the text replaced; all columns and rows stay. ``back`` undoes it."""
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else replaced(t, key, back)[0] for t in batch.column(place).to_pylist()]
            columns = [*batch.columns[:place], pa.array(texts, pa.string()), *batch.columns[place + 1 :]]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def personal_values(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``text`` with pseudonyms, ``n_values`` and ``kinds``, the kinds found."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [(None, {}) if t is None else replaced(t, key) for t in batch.column(1).to_pylist()]
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array([t for t, _ in done], pa.string()),
                    pa.array([sum(map(len, f.values())) for _, f in done], pa.int64()),
                    pa.array([sorted(f) for _, f in done], pa.list_(pa.string())),
                ],
                ["_id", "text", "n_values", "kinds"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(docs[id_col].alias("_id"), docs[text_col].alias("_text"))
    return rows.mapInArrow(run, f"_id {kind}, text string, n_values long, kinds array<string>").withColumnRenamed(
        "_id", id_col
    )
