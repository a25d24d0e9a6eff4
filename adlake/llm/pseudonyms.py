"""Format-preserving pseudonyms for personal numbers, dates and mail addresses.

A value counts if it is valid in its kind: payment cards by their check digit, bank accounts by theirs, social security
numbers and internet addresses by range, dates by the calendar, telephone numbers and mail addresses by form. The valid
values of a kind are numbered, and a keyed Feistel network permutes the numbers, walking on until it meets a number of
the same kind, so the result is valid, has the form of the original, and is undone by the same key. Equal values stay
equal in all documents, also if they are written with other separators; nothing is stored and nothing is shuffled. A
date that can only be month before day, and would not be so any more, gets the next one that is. Telephone numbers keep their country code.
Digits are those of ASCII; others are not values.
Where digits or capitals next to a value make a longer match that fails, the value is told apart from them; if they would
make a valid match with its pseudonym, it gets the next one, so that the key still undoes it.

Cases: a null text stays null, an empty one empty; text around the values is kept to the byte. Rows are treated one by
one, repeated doc_ids included. The caller's columns pass through untouched.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from datetime import date
from functools import lru_cache
from math import isqrt
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from adlake.llm.words import pieces, texts

#: For tests and checks. Give a secret of your own in production.
SAMPLE_KEY = b"sample key, not a secret"
ROUNDS = 10
KINDS = ("email", "iban", "date", "ip", "phone", "ssn", "card")
RESULT = f"struct<text:string,{','.join(f'{k}:int' for k in KINDS)}>"
FIRST_DAY, DAYS = date(1900, 1, 1).toordinal(), date(2100, 1, 1).toordinal() - date(1900, 1, 1).toordinal()


def feistel(x: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    """A keyed permutation of 0 to size - 1."""
    if size < 2:
        return x
    a = isqrt(size - 1) + 1
    b = -(-size // a)

    def once(x: int) -> int:
        left, right = divmod(x, b)
        for k in reversed(range(ROUNDS)) if back else range(ROUNDS):
            seed = f"{tweak}:{size}:{k}:{left if k % 2 else right}".encode()
            f = int.from_bytes(hashlib.blake2b(seed, key=key, digest_size=32).digest(), "big")
            if k % 2:
                right = (right - f if back else right + f) % b
            else:
                left = (left - f if back else left + f) % a
        return left * b + right

    x = once(x)
    while x >= size:  # the next number of the kind: a x b is little more than size
        x = once(x)
    return x


class Kind(NamedTuple):
    """``number``: (number, how many there are, what the number leaves out), or None if the value isn't valid."""

    pattern: str
    number: Callable[[str], tuple[int, int, object] | None]
    value: Callable[[int, str, object], str]


_DIGITS = frozenset("0123456789")


def _digits(s: str) -> str:
    return "".join(c for c in s if c in _DIGITS)


def _fill(form: str, digits: str) -> str:
    """The digits in the places of the form's."""
    left = iter(digits)
    return "".join(next(left) if c in _DIGITS else c for c in form)


def luhn(digits: str) -> bool:
    doubled = [d if k % 2 == 0 else 2 * d - 9 * (d > 4) for k, d in enumerate(int(c) for c in reversed(digits))]
    return sum(doubled) % 10 == 0


def _card(s: str):
    d = _digits(s)
    if not 13 <= len(d) <= 19 or len(set(d)) == 1 or not luhn(d):
        return None
    return int(d[1:-1]), 10 ** (len(d) - 2), d[0]


def _card_back(x: int, form: str, first) -> str:
    n = len(_digits(form))
    body = f"{first}{x:0{n - 2}d}"
    return _fill(form, next(body + c for c in "0123456789" if luhn(body + c)))


#: The country codes of two digits; those that begin with 1 or 7 have one, all others three.
_TWO_DIGITS = frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())


def _country(digits: str) -> str:
    return digits[: 1 if digits[0] in "17" else 2 if digits[:2] in _TWO_DIGITS else 3]


def _phone(s: str):
    d = _digits(s)
    country = _country(d) if s[0] == "+" else ""
    rest = d[len(country) :]
    if not 8 <= len(d) <= 15 or len(rest) < 6:
        return None
    return int(rest), 10 ** len(rest), country


def _phone_back(x: int, form: str, country) -> str:
    return _fill(form, f"{country}{x:0{len(_digits(form)) - len(country)}d}")


def _ip(s: str):
    parts = s.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    return int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, None


def _ip_back(x: int, form: str, _) -> str:
    return ".".join(map(str, x.to_bytes(4, "big")))


def _ssn(s: str):
    area, group, serial = (int(p) for p in re.split("[- ]", s))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    return ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999, None


def _ssn_back(x: int, form: str, _) -> str:
    x, serial = divmod(x, 9999)
    area, group = divmod(x, 99)
    return _fill(form, f"{area + 1 + (area >= 665):03d}{group + 1:02d}{serial + 1:04d}")


def _date(s: str):
    parts = re.split(r"([-/.])", s)
    if parts[1] != parts[3]:
        return None
    a, b, c = int(parts[0]), int(parts[2]), int(parts[4])
    orders = [("ymd", a, b, c)] if len(parts[0]) == 4 else [("dmy", c, b, a), ("mdy", c, a, b)]
    for order, *day in orders:
        try:
            x = date(*day).toordinal() - FIRST_DAY
        except ValueError:
            continue
        if 0 <= x < DAYS:
            return x, DAYS, order
    return None


def _date_back(x: int, form: str, order) -> str:
    day = date.fromordinal(x + FIRST_DAY)
    sign = re.search(r"[-/.]", form)[0]
    return sign.join({"y": f"{day.year:04d}", "m": f"{day.month:02d}", "d": f"{day.day:02d}"}[c] for c in order)


#: Characters that a mail address or account number permutes among themselves.
_GROUPS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _mixed(s: str) -> tuple[int, int]:
    x, size = 0, 1
    for c in s:
        for group in _GROUPS:
            if c in group:
                x, size = x * len(group) + group.index(c), size * len(group)
    return x, size


def _mixed_back(x: int, form: str) -> str:
    out = []
    for c in reversed(form):
        for group in _GROUPS:
            if c in group:
                x, k = divmod(x, len(group))
                c = group[k]
                break
        out.append(c)
    return "".join(reversed(out))


def _email_parts(s: str) -> tuple[str, str]:
    """What is permuted and what stays: the local part, and the first label too if the local part has few forms."""
    local, host = s.split("@")
    if _mixed(local)[1] >= 10**6:
        return local, "@" + host
    label, rest = host.split(".", 1)
    return f"{local}@{label}", "." + rest


def _email(s: str):
    own, rest = _email_parts(s)
    x, size = _mixed(own)
    form = "".join("0" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else c for c in own)
    return (x, size, (form, rest)) if size > 1 else None


def _email_back(x: int, form: str, kept) -> str:
    return _mixed_back(x, kept[0]) + kept[1]


def _remainder(s: str) -> int:
    return int("".join(str(int(c, 36)) for c in s)) % 97


def _iban(s: str):
    plain = s.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _remainder(plain[4:] + plain[:4]) != 1:
        return None
    form = "".join("0" if c in _DIGITS else "A" for c in plain[4:])
    return *_mixed(plain[4:]), (plain[:2], form)


def _iban_back(x: int, form: str, kept) -> str:
    country, body_form = kept
    body = _mixed_back(x, body_form)
    left = iter(f"{country}{98 - _remainder(body + country + '00'):02d}{body}")
    return "".join(c if c == " " else next(left) for c in form)


_OF: dict[str, Kind] = {
    "email": Kind(r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![\w@])", _email, _email_back),
    "iban": Kind(r"(?<!\w)[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?(?!\w)", _iban, _iban_back),
    "date": Kind(r"(?<![\w./-])(?:[0-9]{4}-[0-9][0-9]-[0-9][0-9]|[0-9]{4}/[0-9][0-9]/[0-9][0-9]|[0-9][0-9][./-][0-9][0-9][./-][0-9]{4})(?![\w/-])(?!\.[0-9])", _date, _date_back),
    "ip": Kind(r"(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\w)(?!\.[0-9])", _ip, _ip_back),
    "phone": Kind(r"(?<![\w+])(?:\+[0-9]{1,3}[ .-]?)(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?!\w)|(?<![\w+(])\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?!\w)|(?<![\w+.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![\w-])", _phone, _phone_back),
    "ssn": Kind(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])", _ssn, _ssn_back),
    "card": Kind(r"(?<![\w-])[0-9](?:[ -]?[0-9]){12,18}(?![\w-])", _card, _card_back),
}
_FIND = re.compile("|".join(f"(?P<{k}>{_OF[k].pattern})" for k in KINDS))
_AT = {k: re.compile(_OF[k].pattern) for k in KINDS}
#: Within a match that fails, a card may also begin after a hyphen.
_CARD_WITHIN = re.compile(_OF["card"].pattern.removeprefix(r"(?<![\w-])"))
#: Borders between the groups of a kind.
_BORDERS = {"iban": " ", "phone": " .-", "card": " -"}
_IBAN_LENGTHS = {
    length: countries.split()
    for length, countries in {
        15: "NO",
        16: "BE",
        18: "DK FI FK FO GL NL SD",
        19: "MK SI",
        20: "AT BA EE KZ LT LU MN XK",
        21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA",
        23: "AE GI IL IQ OM SO TL",
        24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST",
        26: "IS TR",
        27: "BI DJ FR GR IT MC SM",
        28: "AL AZ BY CY DO GT HU LB NI PL SV",
        29: "BR EG PS QA UA",
        30: "JO KW MU YE",
        31: "MT SC",
        32: "LC",
        33: "RU",
    }.items()
}
_IBAN_LENGTH = {country: length for length, countries in _IBAN_LENGTHS.items() for country in countries}


def _ends(kind: str, value: str) -> Iterator[int]:
    """Where a value may end: the whole match, then its borders, the longest first; an account at its country's length, or whole."""
    ends = [len(value), *(k for k in reversed(range(len(value))) if value[k] in _BORDERS.get(kind, ""))]
    if kind == "iban":
        own = _IBAN_LENGTH.get(value[:2])
        if own:
            ends = [*(end for end in ends if end - value.count(" ", 0, end) == own), len(value)]
    yield from ends


class Hit(NamedTuple):
    """A value at ``start`` to ``end``; whether it was told apart depends on what stands at ``low`` to ``high``."""

    kind: str
    start: int
    end: int
    low: int
    high: int


def _hits(text: str) -> Iterator[Hit]:
    """The valid values. A match that fails is tried with shorter ends and searched from its next border on."""
    at, low, reach, inside = 0, 0, 0, False
    while True:
        m = _CARD_WITHIN.match(text, at) if inside else None
        m = m or _FIND.search(text, at)
        if m is None:
            return
        start, first = m.start(), m.lastgroup or "card"
        if start >= reach:
            low = start
        for kind in (first, *(k for k in KINDS if k != first)):
            found = m if kind == first else _AT[kind].match(text, start)
            if found is None:
                continue
            reach = max(reach, found.end())
            end = next((e for e in _ends(kind, found[0]) if _OF[kind].number(found[0][:e]) is not None), None)
            if end is not None:
                yield Hit(kind, start, start + end, low, reach)
                at, reach, inside = start + end, 0, False
                break
        else:
            borders = (k + 1 for k in range(start, m.end()) if text[k] in _BORDERS.get(first, ""))
            at = next(borders, m.end())
            inside = first == "card" and text[at - 1] == "-"


@lru_cache(maxsize=50_000)
def pseudonym(kind: str, value: str, key: bytes, back: bool = False) -> str | None:
    """The value that stands for a value of a kind, or None if it isn't valid."""
    of = _OF[kind]
    found = of.number(value)
    if found is None:
        return None
    x, size, rest = found
    while True:  # walks on where the new value would be read as another number, e.g. a day as a month
        x = feistel(x, size, key, kind, back)
        new = of.value(x, value, rest)
        if of.number(new) == (x, size, rest):
            return new


def _stays(text: str, hit: Hit, new: str) -> bool:
    """Whether the new value is told apart in its place as the old one was."""
    around = text[hit.low : hit.start] + new + text[hit.end : hit.high]
    start = hit.start - hit.low
    found = next(_hits(around), None)
    return found is not None and (found.kind, found.start, found.end) == (hit.kind, start, start + len(new))


def rewrite(text: str, key: bytes, back: bool = False) -> tuple[str, dict[str, int]]:
    counts = dict.fromkeys(KINDS, 0)
    out, at = [], 0
    for hit in _hits(text):
        value = text[hit.start : hit.end]
        new = pseudonym(hit.kind, value, key, back)
        if (hit.low, hit.high) != (hit.start, hit.end) and _stays(text, hit, value):
            while not _stays(text, hit, new):  # walks on as the network does, so that the key undoes it
                new = pseudonym(hit.kind, new, key, back)
        out += [text[at : hit.start], new]
        at = hit.end
        counts[hit.kind] += 1
    return "".join([*out, text[at:]]), counts


_MARKS = np.isin(np.arange(256), np.frombuffer(b"0123456789@", np.uint8))


def _rewrite_all(column: pa.Array, key: bytes, back: bool) -> pa.Array:
    """Only texts with a digit or an @ are looked into."""
    some = np.zeros(len(column), bool)
    for row, piece in pieces(texts(column)):
        at = np.searchsorted(np.flatnonzero(_MARKS[piece.data]), piece.offsets)
        some[row : row + len(at) - 1] = np.diff(at) > 0
    counts = {k: np.zeros(len(column), np.int32) for k in KINDS}
    new = []
    for row in np.flatnonzero(some):
        text, found = rewrite(column[int(row)].as_py(), key, back)
        new.append(text)
        for k, n in found.items():
            counts[k][row] = n
    column = column.cast(pa.string())
    text = pc.replace_with_mask(column, pa.array(some), pa.array(new, pa.string())) if new else column
    return pa.StructArray.from_arrays([text, *(pa.array(counts[k]) for k in KINDS)], ["text", *KINDS])


def pseudonymise(text: Column, key: bytes = SAMPLE_KEY, back: bool = False) -> Column:
    """struct(text, and how many values of each kind were replaced). ``back`` undoes it with the same key."""

    @F.arrow_udf(RESULT)
    def replaced(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            yield _rewrite_all(column, key, back)

    return replaced(text)
