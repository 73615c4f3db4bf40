"""PII: format-preserving Feistel pseudonyms.

Values are found by pattern and validated; each valid value is replaced by the
image of a keyed permutation of its own format.  The permutation is a Feistel
network over an integer range (cycle-walking into ranges that are not products), so
equal values get equal pseudonyms in all documents, different values get
different ones, a pseudonym passes the same validation, and who holds the key
can invert it.

    card     13-19 digits with a valid Luhn digit, also inside a longer run of digit
             groups; separators, first digit and a valid check digit are kept
    phone    10 digits in a telephone layout, with or without country code
    e164     8-15 digits after a plus sign; the country code is kept
    ipv4     four numbers up to 255
    ssn      valid 3-2-4 numbers
    iban     valid mod-97 account numbers in either case; the country is kept
    date     calendar dates from 1900 to 2099 in seven layouts; a date that is valid
             with day or month first is read as is usual with its separator
    email    letters and digits of the local part, of any length and script; letters
             outside ASCII stay in their case and block of 256 code points
    secret   32 or more hex digits assigned to a token, key, secret or password

Numbers that fail validation are left alone and hide no other number.  Of a run of digit groups the sub-runs in a layout of cards
are tried first, then the longest; a pseudonym is inverted exactly unless another
sub-run that holds it and is tried before happens to pass the check.  The default key is for tests;
production passes its own, of any length.

Defined results: a null text stays null and an empty one empty; a text of any
length is processed whole; repeated rows get equal results; an empty table gives
an empty table.  Columns named ``n_pseudonyms`` in the input are replaced.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re
import string
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import scan

KEY = b"corelode test key"
ROUNDS = 8
FIRST_DAY, DAYS = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal() - dt.date(1900, 1, 1).toordinal() + 1


class Feistel:
    """A keyed permutation of 0 .. size-1."""

    def __init__(self, key: bytes, tweak: str, size: int):
        self.size = size
        self.a = isqrt(size - 1) + 1 if size > 1 else 1
        self.b = -(-size // self.a)
        key = key if len(key) <= 64 else hashlib.blake2b(key).digest()
        self.base = hashlib.blake2b(f"{tweak}:{size}".encode(), key=key, digest_size=32).digest()

    def _f(self, r: int, x: int) -> int:
        return int.from_bytes(hashlib.blake2b(r.to_bytes(1, "big") + x.to_bytes((x.bit_length() + 7) // 8, "big"), key=self.base, digest_size=16).digest(), "big")

    def _once(self, v: int) -> int:
        left, right = divmod(v, self.b)
        for r in range(ROUNDS):
            if r % 2 == 0:
                left = (left + self._f(r, right)) % self.a
            else:
                right = (right + self._f(r, left)) % self.b
        return left * self.b + right

    def _back(self, v: int) -> int:
        left, right = divmod(v, self.b)
        for r in range(ROUNDS - 1, -1, -1):
            if r % 2 == 0:
                left = (left - self._f(r, right)) % self.a
            else:
                right = (right - self._f(r, left)) % self.b
        return left * self.b + right

    def forward(self, v: int) -> int:
        v = self._once(v)
        while v >= self.size:
            v = self._once(v)
        return v

    def inverse(self, v: int) -> int:
        v = self._back(v)
        while v >= self.size:
            v = self._back(v)
        return v


def luhn_digit(payload: str) -> int:
    total = 0
    for k, c in enumerate(reversed(payload)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def is_card(digits: str) -> bool:
    return 13 <= len(digits) <= 19 and luhn_digit(digits[:-1]) == int(digits[-1]) and len(set(digits)) > 1


def _number(x: str) -> int:
    return int("".join(str(int(c, 36)) for c in x))


def is_iban(flat: str) -> bool:
    return 15 <= len(flat) <= 34 and _number(flat[4:] + flat[:4]) % 97 == 1


def _refill(layout: str, digits: str) -> str:
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in layout)


class Pseudonyms:
    """Pseudonyms of values under one key; ``back`` inverts."""

    def __init__(self, key: bytes = KEY, back: bool = False):
        self.key, self.back = key, back
        self.one = lru_cache(maxsize=1 << 16)(self._one)

    def permute(self, kind: str, size: int, v: int) -> int:
        f = _network(self.key, kind, size)
        return f.inverse(v) if self.back else f.forward(v)

    def _digits(self, kind: str, digits: str) -> str:
        return str(self.permute(kind, 10 ** len(digits), int(digits))).zfill(len(digits)) if digits else ""

    def _one(self, kind: str, value: str) -> str | None:
        return getattr(self, kind)(value)

    def card(self, v: str) -> str | None:
        d = re.sub(r"\D", "", v)
        if not is_card(d):
            return None
        body = d[0] + self._digits(f"card{d[0]}", d[1:-1])
        return _refill(v, body + str(luhn_digit(body)))

    def phone(self, v: str) -> str | None:
        d = re.sub(r"\D", "", v)
        if len(d) < 10:
            return None
        return _refill(v, d[:-10] + self._digits("phone", d[-10:]))

    def e164(self, v: str) -> str | None:
        d = re.sub(r"\D", "", v)
        if not 8 <= len(d) <= 15:
            return None
        n = 1 if d[0] in "17" else 2 if d[:2] in COUNTRIES else 3
        return _refill(v, d[:n] + self._digits(f"e164:{d[:n]}", d[n:]))

    def ipv4(self, v: str) -> str | None:
        parts = [int(x) for x in v.split(".")]
        if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in v.split(".")):
            return None
        n = self.permute("ipv4", 1 << 32, int.from_bytes(bytes(parts), "big"))
        return ".".join(str(b) for b in n.to_bytes(4, "big"))

    def ssn(self, v: str) -> str | None:
        a, g, s = (int(x) for x in v.split("-"))
        if a in (0, 666) or a >= 900 or g == 0 or s == 0:
            return None
        rank = ((a - 1 - (a > 666)) * 99 + g - 1) * 9999 + s - 1
        rest, s = divmod(self.permute("ssn", 898 * 99 * 9999, rank), 9999)
        a, g = divmod(rest, 99)
        return f"{a + 1 + (a + 1 >= 666):03d}-{g + 1:02d}-{s + 1:04d}"

    def iban(self, v: str) -> str | None:
        flat = v.replace(" ", "")
        if not is_iban(flat):
            return None
        body = flat[4:]
        body = _refill(body, self._digits("iban" + flat[:2].upper(), re.sub(r"\D", "", body)))
        check = 98 - _number(body + flat[:2] + "00") % 97
        out = iter(flat[:2] + f"{check:02d}" + body)
        return "".join(c if c == " " else next(out) for c in v)

    def date(self, v: str) -> str | None:
        for pattern, layouts in DATES:
            if pattern.fullmatch(v):
                break
        else:
            return None
        for k, layout in enumerate(layouts):
            try:
                day = dt.datetime.strptime(v, layout).date()
            except ValueError:
                continue
            at = day.toordinal() - FIRST_DAY
            if not 0 <= at < DAYS:
                return None
            if k == 0:
                return dt.date.fromordinal(FIRST_DAY + self.permute("date", DAYS, at)).strftime(layout)
            # read the other way round only where the usual way fails: such dates are permuted among themselves
            late = _late_days()
            new = late[self.permute("late", len(late), bisect_left(late, at))]
            return dt.date.fromordinal(FIRST_DAY + new).strftime(layout)
        return None

    def email(self, v: str) -> str | None:
        local, _, domain = v.rpartition("@")
        sets = [(k, _letters(c)) for k, c in enumerate(local) if c.isalnum()]
        sets = [(k, x) for k, x in sets if len(x) > 1]
        if not sets:
            return None
        n, size = 0, 1
        for k, letters in sets:
            n, size = n * len(letters) + letters.index(local[k]), size * len(letters)
        kinds = ",".join(letters[0] for _, letters in sets)
        n = self.permute(f"email:{domain.lower()}:{kinds.lower()}", size, n)
        out = list(local)
        for k, letters in reversed(sets):
            n, r = divmod(n, len(letters))
            out[k] = letters[r]
        return f"{''.join(out)}@{domain}"

    def secret(self, v: str) -> str | None:
        n = self.permute("secret", 16 ** len(v), int(v, 16))
        out = f"{n:x}".zfill(len(v))
        return out.upper() if v.isupper() else out


@lru_cache(maxsize=1)
def _late_days() -> list[int]:
    """Days, counted from the first, on the thirteenth or later of a month."""
    return [k for k in range(DAYS) if dt.date.fromordinal(FIRST_DAY + k).day > 12]


@lru_cache(maxsize=4096)
def _letters(c: str) -> str:
    """The characters among which ``c`` is permuted: digits, letters of its case and block."""
    if c.isascii():
        return string.digits if c.isdigit() else string.ascii_lowercase if c.islower() else string.ascii_uppercase
    kind, block = unicodedata.category(c), ord(c) & ~255
    # letters that change under normalisation are left out, so that texts stay normalised
    stays = lambda x: unicodedata.category(x) == kind and unicodedata.normalize("NFKC", x) == x
    out = "".join(x for x in map(chr, range(max(block, 128), block + 256)) if stays(x))
    return out if c in out else c


@lru_cache(maxsize=4096)
def _network(key: bytes, kind: str, size: int) -> Feistel:
    return Feistel(key, kind, size)


# country codes of two digits; 1 and 7 have one, all others three
COUNTRIES = set("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
# digits a group of the usual card numbers
CARD_LAYOUTS = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3), *((n,) for n in range(13, 20))}
DATES = [(re.compile(p, re.ASCII), f) for p, f in ((r"\d{4}-\d\d-\d\d", ["%Y-%m-%d"]), (r"\d{4}/\d\d/\d\d", ["%Y/%m/%d"]), (r"\d\d/\d\d/\d{4}", ["%m/%d/%Y", "%d/%m/%Y"]), (r"\d\d\.\d\d\.\d{4}", ["%d.%m.%Y"]), (r"\d\d-\d\d-\d{4}", ["%d-%m-%Y", "%m-%d-%Y"]))]
_NUMBERS = re.compile(
    r"(?P<iban>(?<![0-9A-Za-z])[A-Za-z]{2}\d\d(?: ?[0-9A-Za-z]{4}){2,7}(?: ?[0-9A-Za-z]{1,3})?(?![0-9A-Za-z]))"
    r"|(?P<date>(?<![\d.,/-])(?:\d{4}-\d\d-\d\d|\d{4}/\d\d/\d\d|\d\d/\d\d/\d{4}|\d\d\.\d\d\.\d{4}|\d\d-\d\d-\d{4})(?![\d/-]))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d\d-\d{4}(?![\d-]))"
    r"|(?P<ipv4>(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.?\d))"
    r"|(?P<phone>(?<![\d+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d))"
    r"|(?P<e164>(?<![\d+])\+[1-9](?:[ .()/-]{0,2}\d){7,14}(?!\d))",
    re.ASCII,
)
_CARDS = re.compile(r"(?<![\d-])\d(?:[ -]?\d){12,}(?![\d-])", re.ASCII)
_GROUP = re.compile(r"\d+", re.ASCII)
_START = re.compile(r"[0-9]", re.ASCII)
_EMAIL_RIGHT = re.compile(r"[^\W_](?:(?:[^\W_]|-)*[^\W_])?(?:\.[^\W_](?:(?:[^\W_]|-)*[^\W_])?)*\.[^\W\d_]{2,}")
_SECRET = re.compile(r"(?i:token|key|secret|password|passwd|pwd)[\"']?\s*[:=]\s*[\"']?([0-9a-f]{32,}|[0-9A-F]{32,})(?![0-9A-Za-z])")


def _cards(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Ranges of the valid cards in a run of digit groups: whole groups, without overlaps, in order."""
    groups = [m.span() for m in _GROUP.finditer(text, start, end)]
    tries = []
    for i in range(len(groups)):
        digits = 0
        for j in range(i, len(groups)):
            digits += groups[j][1] - groups[j][0]
            if digits > 19:
                break
            if digits >= 13:
                usual = tuple(b - a for a, b in groups[i : j + 1]) in CARD_LAYOUTS
                tries.append((not usual, -digits, i, j))
    out: list[tuple[int, int]] = []
    taken = bytearray(len(groups))
    for _, _, i, j in sorted(tries):
        a, b = groups[i][0], groups[j][1]
        if not any(taken[i : j + 1]) and is_card(re.sub(r"\D", "", text[a:b])):
            taken[i : j + 1] = b"\1" * (j + 1 - i)
            out.append((a, b))
    return out


def _numbers(text: str) -> list[tuple[int, int, str]]:
    """Cards and candidates of ``_NUMBERS``: of those that overlap the first stays, a card last of equal starts."""
    out = [(a, b, "card") for m in _CARDS.finditer(text) for a, b in _cards(text, *m.span())]
    at = 0
    while m := _NUMBERS.search(text, at):
        at = m.end()
        if m.lastgroup == "iban" and not is_iban(m.group().replace(" ", "")):
            at = m.start() + 1
        else:
            out.append((*m.span(), str(m.lastgroup)))
    out.sort(key=lambda m: (m[0], m[2] == "card"))
    kept: list[tuple[int, int, str]] = []
    for m in out:
        if not kept or m[0] >= kept[-1][1]:
            kept.append(m)
    return kept


def _local_part(text: str, at: int) -> int:
    """Where the local part of an address begins that ends before ``at``; ``at`` if there is none."""
    if not at or not text[at - 1].isalnum():
        return at
    i = at
    while i and (text[i - 1].isalnum() or text[i - 1] in "._%+-"):
        i -= 1
    while not text[i].isalnum():
        i += 1
    return i


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of each candidate, in order and without overlaps."""
    out: list[tuple[int, int, str]] = []
    at = text.find("@")
    while at >= 0:
        left = _local_part(text, at)
        right = _EMAIL_RIGHT.match(text, at + 1) if left < at else None
        if right:
            out.append((left, right.end(), "email"))
        at = text.find("@", at + 1)
    if _START.search(text):
        out += [(m.start(1), m.end(1), "secret") for m in _SECRET.finditer(text)]
        out += _numbers(text)
    out.sort(key=lambda m: (m[0], -m[1]))
    kept: list[tuple[int, int, str]] = []
    for m in out:
        if not kept or m[0] >= kept[-1][1]:
            kept.append(m)
    return kept


def rewrite(text: str, names: Pseudonyms) -> tuple[str, int]:
    """The text with pseudonyms, and how many there are."""
    parts, last, n = [], 0, 0
    for a, b, kind in find(text):
        new = names.one(kind, text[a:b])
        if new is not None:
            parts += [text[last:a], new]
            last, n = b, n + 1
    return ("".join([*parts, text[last:]]), n) if n else (text, 0)


def pseudonymise(docs: DataFrame, key: bytes = KEY, text: str = "text", back: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in the text, and ``n_pseudonyms``; ``back`` inverts them."""
    docs = docs.drop("n_pseudonyms")
    scan.small_batches(docs.sparkSession)
    names = docs.columns
    at = names.index(text)
    inner = docs.toDF(*[f"c{i}" for i in range(len(names))])
    columns = [*inner.columns, "n_pseudonyms"]
    fields = [T.StructField(f.name, T.StringType() if i == at else f.dataType) for i, f in enumerate(inner.schema.fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        who = Pseudonyms(key, back)  # values already seen by the task are remembered
        for batch in batches:
            n = np.zeros(batch.num_rows, dtype=np.int64)
            out = []
            for r, t in enumerate(batch.column(at).cast(pa.string()).to_pylist()):
                if t:
                    t, n[r] = rewrite(t, who)
                out.append(t)
            cols = [pa.array(out, pa.string()) if i == at else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n)], columns)

    return inner.mapInArrow(run, T.StructType([*fields, T.StructField("n_pseudonyms", T.LongType())])).toDF(*names, "n_pseudonyms")


