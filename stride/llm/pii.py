"""Format-preserving pseudonyms for personal data.

Validated values are replaced by other valid values of the same format:

* ``card``: 13 to 19 digits with a right Luhn sum; the first digit and the layout stay, the check digit is made anew;
* ``iban``: the length of its country and a right mod-97 sum; country and the classes of characters stay, the check digits are made anew;
* ``ssn``: ddd-dd-dddd with valid parts;
* ``phone``: international numbers (with a layout, or bare after their plus sign) and North American
  ones with a layout; the country code and the layout stay;
* ``ip``: IPv4 with four octets up to 255;
* ``date``: calendar dates of 1900 to 2099 as y-m-d, d.m.y or d/m/y (m/d/y where only that is a date);
* ``email``: the letters and digits of the local part; the domain and punctuation stay.

A value is numbered within its format, and the number goes through a keyed
Feistel network over pairs of numbers just large enough for the format; results
outside it go round again (cycle walking).  So the map is a permutation of each
format under the key: equal values get equal pseudonyms in every document
without any table or shuffle, unequal ones stay unequal, and ``reveal`` with the
key gives the values back.  A format with few values (a one-letter local part) may
map a value to itself.

Each text is handled where it is read; the Feistel map needs no state.

Edge cases: a null text stays null, an empty one empty; a run of digit groups that fails
its check as a whole is tried by shorter runs of its groups (the first and longest valid
one counts), and what passes no check is left as it is; overlapping finds go to the one that starts first,
then in the order above; repeated rows get equal results; other columns are
never read.
"""
from __future__ import annotations

import datetime
import functools
import hashlib
import math
import os
import re
import secrets
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stride.llm.common import map_texts, read_table

ROUNDS = 10


#: Lengths of account numbers by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21,
    "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27,
    "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27,
    "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25,
    "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23,
    "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}


@dataclass(frozen=True)
class PiiParams:
    key: bytes  # secret of the run: who has it can reveal the values


def session_key(spark: SparkSession) -> bytes:
    """The secret named by ``spark.stride.pii.key`` or STRIDE_PII_KEY; without either, one drawn
    for this application and kept nowhere else, so its pseudonyms can't be revealed later."""
    given = spark.conf.get("spark.stride.pii.key", None) or os.environ.get("STRIDE_PII_KEY")
    return given.encode()[:64] if given else _drawn(spark.sparkContext.applicationId)


@functools.lru_cache(maxsize=1)
def _drawn(application: str) -> bytes:
    return secrets.token_bytes(32)


def feistel(x: int, size: int, key: bytes, tweak: str, back: bool = False) -> int:
    """Keyed permutation of range(size)."""
    side = math.isqrt(size - 1) + 1
    mask = f"|{tweak}|{size}|".encode()
    while True:
        left, right = divmod(x, side)
        for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if back:
                left, right = (right - _round(key, mask, r, left, side)) % side, left
            else:
                left, right = right, (left + _round(key, mask, r, right, side)) % side
        x = left * side + right
        if x < size:
            return x


def _round(key: bytes, mask: bytes, r: int, value: int, side: int) -> int:
    h = hashlib.blake2b(mask + b"%d|%d" % (r, value), key=key, digest_size=24)
    return int.from_bytes(h.digest(), "big") % side


def walk(x: int, size: int, valid, key: bytes, tweak: str, back: bool) -> int:
    """The permutation of the valid numbers below ``size`` that walking on to the next valid one gives."""
    while True:
        x = feistel(x, size, key, tweak, back)
        if valid(x):
            return x


def fill(layout: str, digits: str) -> str:
    """``digits`` put in place of the digits of ``layout``."""
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in layout)


def only_digits(s: str) -> str:
    return "".join(c for c in s if c.isdigit())


def luhn(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10


def card(s: str, key: bytes, back: bool) -> str | None:
    d = only_digits(s)
    if not 13 <= len(d) <= 19 or luhn(d) or len(set(d)) == 1:
        return None
    n = len(d) - 2

    def make(x):
        body = f"{d[0]}{x:0{n}d}"
        return body + str(-luhn(body + "0") % 10)

    return fill(s, make(walk(int(d[1:-1]), 10 ** n, lambda x: len(set(make(x))) > 1, key, f"card{d[0]}", back)))


def iban(s: str, key: bytes, back: bool) -> str | None:
    c = s.replace(" ", "")
    if IBAN_LENGTHS.get(c[:2]) != len(c) or int("".join(str(int(x, 36)) for x in c[4:] + c[:4])) % 97 != 1:
        return None
    kinds = "".join("d" if x.isdigit() else "a" for x in c[4:])
    number, size = 0, 1
    for x, k in zip(c[4:], kinds):
        base = 10 if k == "d" else 26
        number = number * base + (int(x) if k == "d" else ord(x) - 65)
        size *= base
    number = feistel(number, size, key, f"iban{c[:2]}{kinds}", back)
    out = []
    for k in reversed(kinds):
        number, x = divmod(number, 10 if k == "d" else 26)
        out.append(str(x) if k == "d" else chr(65 + x))
    body = "".join(reversed(out))
    check = 98 - int("".join(str(int(x, 36)) for x in body + c[:2] + "00")) % 97
    it = iter(f"{c[:2]}{check:02d}{body}")
    return "".join(" " if x == " " else next(it) for x in s)


def ssn(s: str, key: bytes, back: bool) -> str | None:
    def valid(x):
        area, rest = divmod(x, 10 ** 6)
        return 0 < area < 900 and area != 666 and 0 < rest // 10 ** 4 and 0 < rest % 10 ** 4

    x = int(only_digits(s))
    return fill(s, f"{walk(x, 10 ** 9, valid, key, 'ssn', back):09d}") if valid(x) else None


def phone(s: str, key: bytes, back: bool) -> str | None:
    m = re.match(r"\+\d{1,3}(?=[ (.-])", s)
    if not m and s[0] == "+":  # bare: the longest country code that the number plan has leads
        m = re.match(r"\+(?:[17]|2[07]|3[0-469]|4[0-13-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})", s)
    head = m.end() if m else 0
    d = only_digits(s[head:])
    if not 7 <= len(d) <= 12 or (not m and len(d) != 10):
        return None
    x = feistel(int(d), 10 ** len(d), key, f"phone{s[:head]}|{len(d)}", back)
    return s[:head] + fill(s[head:], f"{x:0{len(d)}d}")


def ip(s: str, key: bytes, back: bool) -> str | None:
    parts = s.split(".")
    if any(int(x) > 255 or (len(x) > 1 and x[0] == "0") for x in parts):
        return None
    x = feistel(int.from_bytes(bytes(map(int, parts)), "big"), 2 ** 32, key, "ip", back)
    return ".".join(map(str, x.to_bytes(4, "big")))


FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


def date(s: str, key: bytes, back: bool) -> str | None:
    sep = next(c for c in s if not c.isdigit())
    parts = s.split(sep)
    if len(parts) != 3 or len({len(parts[0]), len(parts[2])} & {4}) != 1:
        return None
    order = "ymd" if len(parts[0]) == 4 else "dmy"
    if order == "dmy" and sep == "/" and int(parts[1]) > 12:
        order = "mdy"
    value = dict(zip(order, map(int, parts)))
    try:
        day = datetime.date(value["y"], value["m"], value["d"]).toordinal()
    except ValueError:
        return None
    if not FIRST_DAY <= day <= LAST_DAY:
        return None
    padded = all(len(x) == (4 if k == "y" else 2) for k, x in zip(order, parts))

    def write(x):
        to = datetime.date.fromordinal(FIRST_DAY + x)
        at = {"y": f"{to.year:04d}", "m": f"{to.month:02d}" if padded else str(to.month),
              "d": f"{to.day:02d}" if padded else str(to.day)}
        return sep.join(at[k] for k in order), to

    def valid(x):  # same layout when read again
        text, to = write(x)
        fits = padded or to.month < 10 or to.day < 10
        return fits and (order != "mdy" or to.day > 12)

    if write(day - FIRST_DAY)[0] != s:
        return None
    return write(walk(day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, valid, key, f"date{order}{sep}{padded}", back))[0]


def email(s: str, key: bytes, back: bool) -> str | None:
    at = s.index("@")
    local, domain = s[:at], s[at:]
    kinds = "".join("d" if "0" <= c <= "9" else "a" if c.isascii() and c.isalpha() else c for c in local)
    number, size = 0, 1
    for c, k in zip(local.lower(), kinds):
        if k in "da" and (c.isalnum()):
            base = 10 if k == "d" else 26
            number = number * base + (int(c) if k == "d" else ord(c) - 97)
            size *= base
    if size == 1:
        return None
    number = feistel(number, size, key, f"email{kinds}{domain.lower()}", back)
    out = []
    for c, k in zip(reversed(local), reversed(kinds)):
        if k in "da" and c.isalnum():
            number, x = divmod(number, 10 if k == "d" else 26)
            c = str(x) if k == "d" else chr((65 if c.isupper() else 97) + x)
        out.append(c)
    return "".join(reversed(out)) + domain


#: In order of precedence at one place.
KINDS = {
    "email": (email, r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])"),
    "iban": (iban, r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "date": (date, r"(?<![\d./-])(?:\d{4}-\d{1,2}-\d{1,2}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}/\d{1,2}/\d{4})(?![\d/-])"),
    "ip": (ip, r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d]|\.\d)"),
    "ssn": (ssn, r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    "card": (card, r"(?<![\d-])\d(?:[ -]?\d){12,18}(?![\d])"),
    "phone": (phone, r"(?<![\w+])(?:\+[1-9]\d{8,14}|\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w-])"),
}
_PATTERNS = {k: re.compile(p, re.ASCII) for k, (_, p) in KINDS.items()}
_DIGIT = re.compile("[0-9]")


@functools.lru_cache(maxsize=65536)
def replace(kind: str, value: str, key: bytes, back: bool = False) -> str | None:
    return KINDS[kind][0](value, key, back)


#: Kinds whose groups of characters may stand beside others that are not theirs.
GROUPED = {"card": re.compile(r"[0-9]+"), "iban": re.compile(r"[A-Z0-9]+")}


def parts(kind: str, value: str, key: bytes, back: bool) -> list[tuple[int, int, str]]:
    """(start, end, replacement) of the valid values in a match: the whole, or runs of its
    groups, from the left, the longest first."""
    new = replace(kind, value, key, back)
    if new is not None or kind not in GROUPED:
        return [(0, len(value), new)] if new is not None else []
    groups = [m.span() for m in GROUPED[kind].finditer(value)]
    out, i = [], 0
    while i < len(groups):
        for j in range(len(groups), i, -1):
            a, b = groups[i][0], groups[j - 1][1]
            new = replace(kind, value[a:b], key, back)
            if new is not None:
                out.append((a, b, new))
                i = j - 1
                break
        i += 1
    return out


def finds(text: str, key: bytes, back: bool = False) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, replacement) of the valid values, without overlaps."""
    out = []
    has_digit = _DIGIT.search(text) is not None
    for no, (kind, pattern) in enumerate(_PATTERNS.items()):
        if ("@" in text) if kind == "email" else has_digit:
            for m in pattern.finditer(text):
                out += [(m.start() + a, no, m.start() + b, kind, new) for a, b, new in parts(kind, m.group(), key, back)]
    out.sort()
    kept, end = [], 0
    for a, _, b, kind, new in out:
        if a >= end:
            kept.append((a, b, kind, new))
            end = b
    return kept


def pseudonymise(text: str, key: bytes, back: bool = False) -> tuple[str, list[str]]:
    """The text with pseudonyms and the kinds that were found; ``back`` reveals them again."""
    parts, at, kinds = [], 0, []
    for a, b, kind, new in finds(text, key, back):
        parts += [text[at:a], new]
        kinds.append(kind)
        at = b
    return "".join([*parts, text[at:]]) if kinds else text, kinds


def pseudonyms(docs: DataFrame, p: PiiParams) -> DataFrame:
    """doc_id, text with pseudonyms, n_<kind> of each document."""
    key, kinds = p.key, list(KINDS)

    def run(texts):
        done = [pseudonymise(t, key) for t in texts]
        return {"new_text": [t for t, _ in done], **{f"n_{k}": [found.count(k) for _, found in done] for k in kinds}}

    made = ", ".join(["new_text string", *[f"n_{k} int" for k in kinds]])
    marked = docs.select("doc_id", F.col("text").isNull().alias("none"), "text")
    return map_texts(marked, ["doc_id", "none"], made, run).select(
        "doc_id", F.when(~F.col("none"), F.col("new_text")).alias("text"), *[f"n_{k}" for k in kinds])


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms(read_table(spark, sf_dir, "documents"), PiiParams(session_key(spark)))
