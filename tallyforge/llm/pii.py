"""Format-preserving pseudonyms for personal numbers and dates.

Values are found by pattern and validated (Luhn check digit, octets up to
255, calendar dates, social-security ranges); each is replaced by a keyed
permutation of its own format's values: a Feistel network of ten rounds over
the value's number, walked on until the result is valid again.  A permutation
maps equal values to equal pseudonyms in every document and different ones
to different ones, and needs no table of values.  Separators, length and
format stay: cards keep a right check digit, dates stay dates in their
notation, phone numbers keep their country code, addresses their domain.

Defined results: null text stays null, empty text empty; text without
values is unchanged; repeated rows get equal texts; an empty table gives an
empty result.  Spans are code points of the input, end exclusive; a
pseudonym is as long as its value.  Input columns named like an output
column are replaced.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from .util import without

ROUNDS = 10
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()
OUT = {"n_pii": "long", "pii": "array<struct<kind:string,start:long,end:long>>"}
PATTERN = re.compile(r"""
    (?P<iso>(?<![\d-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![\d-]))
  | (?P<ip>(?<![\d.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9]))
  | (?P<dmy>(?<![\d/.])[0-9]{2}[/.][0-9]{2}[/.][0-9]{4}(?![\d/]))
  | (?P<ssn>(?<![\d-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\d-]))
  | (?P<phone>\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9]))
  | (?P<card>(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9]))
""", re.VERBOSE)
# a mail name is a whole run of its characters, looked for from the run's start only
NAMES = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@")
LETTER, DOMAIN = re.compile("[A-Za-z0-9]"), re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
NAME = 64             # characters of a mail name that are one number
CARD = re.compile("(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])")
GROUP, RUN, AFTER_DIGIT = re.compile("[0-9]+"), re.compile("[0-9]+(?:[ -][0-9]+){0,39}"), re.compile("[0-9][ -]")
USUAL = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 1)}       # digits of a card's groups


class Permuter:
    """Keyed permutations of 0..size-1, one for each (kind, size)."""

    def __init__(self, key: bytes):
        self.key = key
        self.value = lru_cache(1 << 16)(self._value)

    def _round(self, kind: str, size: int, i: int, x: int) -> int:
        if size.bit_length() <= 128:
            h = hashlib.blake2b(f"{kind}/{size}/{i}/{x}".encode(), key=self.key, digest_size=16)
            return int.from_bytes(h.digest(), "big")
        need = range(size.bit_length() // 1024 + 1)           # 64 bytes each, for half the size's bits
        h = [hashlib.blake2b(f"{kind}/{size:x}/{i}/{x:x}/{n}".encode(), key=self.key).digest() for n in need]
        return int.from_bytes(b"".join(h), "big")

    def once(self, kind: str, size: int, x: int) -> int:
        """One pass: x = left * width + right in a square that covers the
        size; results outside the size are walked on."""
        width = math.isqrt(size - 1) + 1
        while True:
            left, right = divmod(x, width)
            for i in range(ROUNDS):
                left, right = right, (left + self._round(kind, size, i, right)) % width
            x = left * width + right
            if x < size:
                return x

    def permute(self, kind: str, size: int, x: int, valid=lambda x: True) -> int:
        """A permutation of the valid numbers below ``size``."""
        while True:
            x = self.once(kind, size, x)
            if valid(x):
                return x

    def _value(self, kind: str, text: str) -> str | None:
        """The pseudonym of a value, or None when it isn't valid."""
        return getattr(self, f"_{kind}")(text)

    def _digits(self, kind: str, text: str, skip: int, digits: str) -> str:
        """``text`` with its digits after the first ``skip`` replaced."""
        new, n = iter(digits), 0
        out = []
        for c in text:
            if "0" <= c <= "9":
                n += 1
                out.append(next(new) if n > skip else c)
            else:
                out.append(c)
        return "".join(out)

    def _card(self, text: str) -> str | None:
        own = re.sub("[^0-9]", "", text)
        if luhn(own[:-1]) != own[-1]:
            return None
        n = len(own) - 1
        head = str(self.permute("card", 10 ** n, int(own[:-1]))).zfill(n)
        return self._digits("card", text, 0, head + luhn(head))

    def _phone(self, text: str) -> str | None:
        country = re.match(r"\+([0-9]{1,3}?)(?=[ .(-])|\+([0-9])", text)
        skip = len(country[1] or country[2])
        own = re.sub("[^0-9]", "", text)[skip:]
        if not 7 <= len(own) <= 14:
            return None
        return self._digits("phone", text, skip, str(self.permute("phone", 10 ** len(own), int(own))).zfill(len(own)))

    def _ssn(self, text: str) -> str | None:
        def valid(x: int) -> bool:
            area, group, serial = x // 10 ** 6, x // 10 ** 4 % 100, x % 10 ** 4
            return 0 < area < 900 and area != 666 and group > 0 and serial > 0

        x = int(text.replace("-", ""))
        return self._digits("ssn", text, 0, str(self.permute("ssn", 10 ** 9, x, valid)).zfill(9)) if valid(x) else None

    def _ip(self, text: str) -> str | None:
        """Octets keep their number of digits, so the length stays."""
        parts = text.split(".")
        if any(int(p) > 255 or p != str(int(p)) for p in parts):
            return None
        low = [{1: 0, 2: 10, 3: 100}[len(p)] for p in parts]
        many = [{1: 10, 2: 90, 3: 156}[len(p)] for p in parts]
        x = 0
        for p, a, m in zip(parts, low, many, strict=True):
            x = x * m + int(p) - a
        size = many[0] * many[1] * many[2] * many[3]
        x = self.permute("ip" + "".join(str(len(p)) for p in parts), size, x)
        out = []
        for a, m in zip(reversed(low), reversed(many), strict=True):
            x, r = divmod(x, m)
            out.append(str(a + r))
        return ".".join(reversed(out))

    def _day(self, day: dt.date) -> dt.date | None:
        n = day.toordinal()
        if not FIRST_DAY <= n <= LAST_DAY:
            return None
        return dt.date.fromordinal(FIRST_DAY + self.permute("date", LAST_DAY - FIRST_DAY + 1, n - FIRST_DAY))

    def _iso(self, text: str) -> str | None:
        day = parsed(text[:4], text[5:7], text[8:])
        new = day and self._day(day)
        return new and new.isoformat()

    def _dmy(self, text: str) -> str | None:
        """Day first; month first if only that is a date.  Such dates go to
        others that can only be month-first, so none meets a day-first one."""
        day = parsed(text[6:], text[3:5], text[:2])
        if new := day and self._day(day):
            return f"{new.day:02}{text[2]}{new.month:02}{text[5]}{new.year:04}"
        new = parsed(text[6:], text[:2], text[3:5]) if day is None else None
        while new := new and self._day(new):
            if new.day > 12:
                return f"{new.month:02}{text[2]}{new.day:02}{text[5]}{new.year:04}"
        return None

    def _email(self, text: str) -> str:
        """Letters stay letters of their case, digits digits, in the name."""
        name, domain = text.split("@", 1)
        parts = [name[i:i + NAME] for i in range(0, len(name), NAME)]
        out, before = [], ""
        for p in parts:                       # a long name in parts, each under the ones before it
            out.append(self._name(p, before))
            before = hashlib.blake2b((before + p).encode(), digest_size=16).hexdigest()
        return "".join(out) + "@" + domain

    def _name(self, name: str, before: str) -> str:
        radix = [26 if c.isalpha() else 10 if c.isdigit() else 1 for c in name]
        base = [ord("a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else c) for c in name]
        x, size = 0, 1
        for c, r, b in zip(name, radix, base, strict=True):
            x, size = x * r + ord(c) - b, size * r
        form = "".join("a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else c for c in name)
        x = self.permute("email" + form + before, size, x)
        out = []
        for r, b in zip(reversed(radix), reversed(base), strict=True):
            x, d = divmod(x, r)
            out.append(chr(b + d))
        return "".join(reversed(out))


def luhn(head: str) -> str:
    """The check digit after ``head``."""
    total = 0
    for i, c in enumerate(reversed(head)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 * (d > 9)
    return str(-total % 10)


def parsed(year: str, month: str, day: str) -> dt.date | None:
    try:
        return dt.date(int(year), int(month), int(day))
    except ValueError:
        return None


def card_spans(text: str, groups: list[tuple[int, int]]) -> tuple[tuple[int, int] | None, tuple[int, int] | None]:
    """The valid card from the first group on that is grouped as usual, and
    the longest valid one otherwise."""
    usual, other, digits, sizes = [], None, "", ()
    for a, b in groups:
        digits, sizes = digits + text[a:b], (*sizes, b - a)
        if len(digits) > 19:
            break
        if len(digits) >= 13 and luhn(digits[:-1]) == digits[-1]:
            span = groups[0][0], b
            if len(sizes) == 1 or sizes in USUAL:
                usual.insert(0, span)
            elif sizes[:-1] == (4, 4, 4, 4):
                usual.append(span)
            else:
                other = span
    return usual[0] if usual else None, other


def card_at(text: str, start: int, least: int) -> tuple[int, int] | None:
    """The card at the digit group ``start``, or one grouped as usual that
    the span from there would cut.  Odd groupings count if all groups have
    ``least`` digits."""
    groups = [(start + g.start(), start + g.end()) for g in GROUP.finditer(RUN.match(text, start)[0])]
    usual, other = card_spans(text, groups)
    if usual or not other:
        return usual
    inside = [g for g in groups if g[0] < other[1]]
    if any(b - a < least for a, b in inside):
        return None
    later = (card_spans(text, groups[i:])[0] for i in range(1, len(inside)))
    return next((x for x in later if x), other)


def _mails(text: str) -> Iterator[tuple[int, int, int]]:
    """(start of the name's run, place of the @, end) of mail addresses."""
    for m in NAMES.finditer(text):
        if d := DOMAIN.match(text, m.end()):
            yield m.start(), m.end() - 1, d.end()


def pseudonymise_text(text: str, permuter: Permuter) -> tuple[str, list[tuple[str, int, int]]]:
    """Cards in odd groupings: from a run's first group on any, later ones of
    three digits or more, so that rows of small numbers aren't searched for
    chance check digits; none from within a value of another form."""
    out, spans, at, look, other = [], [], 0, 0, 0
    mails, m = _mails(text), PATTERN.search(text)
    mail = next(mails, None)
    while True:
        if m and m.start() < look:
            m = PATTERN.search(text, look)
        while mail and not (start := LETTER.search(text, max(mail[0], look), mail[1])):
            mail = next(mails, None)
        if mail and (m is None or start.start() <= m.start()):
            kind, a, b = "email", start.start(), mail[2]
        elif m:
            kind, (a, b) = m.lastgroup, m.span()
        else:
            break
        look = a + 1
        new = permuter.value(kind, text[a:b]) if kind != "card" else None
        if new is None and kind != "card":
            other = max(other, b)
        if new is None and CARD.match(text, a):
            first = a <= at + 1 or not AFTER_DIGIT.match(text, a - 2)
            if span := card_at(text, a, 20 if a < other else 1 if first else 3):
                kind, (a, b) = "card", span
                new = permuter.value(kind, text[a:b])
        if new is not None:
            out += [text[at:a], new]
            spans.append(({"iso": "date", "dmy": "date"}.get(kind, kind), a, b))
            at = look = b
    return "".join([*out, text[at:]]), spans


def pseudonymise(docs: DataFrame, key: bytes) -> DataFrame:
    """``docs`` (text, ...) with the values replaced in text, and n_pii, pii."""
    docs = without(docs, *OUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        permuter = Permuter(key)
        digit = re.compile("[0-9@]")
        for batch in batches:
            texts, found = [], []
            for t in batch.column("text").to_pylist():
                new, spans = pseudonymise_text(t, permuter) if t and digit.search(t) else (t, [])
                texts.append(new)
                found.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
            place = batch.schema.get_field_index("text")
            columns = [pa.array(texts, pa.string()) if i == place else c for i, c in enumerate(batch.columns)]
            new = [pa.array([len(f) for f in found], pa.int64()),
                   pa.array(found, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))]
            yield pa.RecordBatch.from_arrays([*columns, *new], [*batch.schema.names, *OUT])

    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"{k} {v}" for k, v in OUT.items()])
    return docs.mapInArrow(run, fields)
