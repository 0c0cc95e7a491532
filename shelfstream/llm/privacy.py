"""Pseudonyms for personal data that keep its format.

Numbers and dates are found by pattern, validated, and sent through a keyed permutation of all
values of the same format, a Feistel network whose rounds are keyed hashes. Equal values
get equal pseudonyms in every document, different values different ones, and whoever holds
the key can turn them back. A pseudonym is never the value itself, and it is valid where the
value was: check digits are computed anew, dates stay dates.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfstream.llm.common import read_table, small_batches

ROUNDS = 8


# ---------------------------------------------------------------- the permutation


def _round(key: bytes, label: bytes, number: int, half: int, modulus: int) -> int:
    text = b"%s|%d|%d|%d" % (label, number, half, modulus)
    digest = hashlib.blake2b(text, key=key, digest_size=24).digest()
    while len(digest) * 8 < modulus.bit_length() + 64:  # long values need more than one digest
        digest += hashlib.blake2b(b"%s|%d" % (text, len(digest)), key=key, digest_size=24).digest()
    return int.from_bytes(digest, "big") % modulus


def _network(x: int, n: int, key: bytes, label: bytes, forward: bool) -> int:
    """A permutation of 0..a*b-1, the least such rectangle that holds 0..n-1."""
    a = math.isqrt(n - 1) + 1
    b = -(-n // a)
    left, right = divmod(x, b)
    for number in range(ROUNDS) if forward else reversed(range(ROUNDS)):
        sign = 1 if forward else -1
        if number % 2:
            right = (right + sign * _round(key, label, number, left, b)) % b
        else:
            left = (left + sign * _round(key, label, number, right, a)) % a
    return left * b + right


def _walk(x: int, n: int, key: bytes, label: bytes, forward: bool) -> int:
    """The same on 0..n-1: a value outside is sent on until it comes back."""
    x = _network(x, n, key, label, forward)
    while x >= n:
        x = _network(x, n, key, label, forward)
    return x


def permute(x: int, n: int, key: bytes, label: str, inverse: bool = False) -> int:
    """A keyed permutation of 0..n-1 that moves every value (if n is over 1).

    Values are sent to another order, one place on in it, and back.
    """
    name = label.encode()
    place = _walk(x, n, key, name, True)
    return _walk((place + (-1 if inverse else 1)) % n, n, key, name, False)


# ---------------------------------------------------------------- formats


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _refill(form: str, digits: str) -> str:
    """``form`` with its digits replaced in order."""
    source = iter(digits)
    return "".join(next(source) if c in "0123456789" else c for c in form)


def luhn_digit(body: str) -> str:
    """The check digit that follows ``body``."""
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


class Kind:
    """One kind of value: where it may stand, whether it is one, and its permutation."""

    pattern: str
    name: str

    def valid(self, text: str) -> bool:
        raise NotImplementedError

    def size(self, text: str) -> int:
        """Length of the value that ``text``, a match of the pattern, begins with; 0 for none."""
        return len(text) if self.valid(text) else 0

    def change(self, text: str, key: bytes, inverse: bool) -> str:
        raise NotImplementedError


class Card(Kind):
    """Payment card: 13 to 19 digits, in groups or not, with a Luhn check digit.

    Where the digits that follow make no longer card, a card in the usual groups is found before
    them. A pseudonym keeps the check sum its digits have when an odd number of digits follows, so
    that it makes a longer card with what follows exactly if the value does.
    """

    name = "card"
    pattern = r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w-])"
    _USUAL = re.compile(r"\d{13,19}|\d{4}([ -])(?:\d{4}\1\d{4}\1\d{4}(?:\1\d{1,3})?|\d{6}\1\d{4,5}|\d{3}\1\d{3}\1\d{3})")

    def valid(self, text: str) -> bool:
        digits = _digits(text)
        return len(set(digits)) > 1 and luhn_digit(digits[:-1]) == digits[-1]

    def size(self, text: str) -> int:
        if self.valid(text):
            return len(text)
        for border in reversed(list(re.finditer("[ -]", text))):
            if self._USUAL.fullmatch(text, 0, border.start()) and self.valid(text[: border.start()]):
                return border.start()
        return 0

    def change(self, text: str, key: bytes, inverse: bool) -> str:
        digits = _digits(text)
        n, odd = len(digits) - 1, luhn_digit(digits)
        while True:  # on to the next value that is a card and has the same sum
            new = permute(int(digits[:-1]), 10**n, key, f"card{n}", inverse)
            digits = f"{new:0{n}d}"
            digits += luhn_digit(digits)
            if len(set(digits)) > 1 and luhn_digit(digits) == odd:
                return _refill(text, digits)


class Social(Kind):
    """United States social security number: 3-2-4, no all-zero part, no 666 or 9xx."""

    name = "ssn"
    pattern = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
    _AREAS = [a for a in range(1, 900) if a != 666]

    def valid(self, text: str) -> bool:
        area, group, serial = map(int, text.split("-"))
        return 0 < area < 900 and area != 666 and group > 0 and serial > 0

    def change(self, text: str, key: bytes, inverse: bool) -> str:
        area, group, serial = map(int, text.split("-"))
        x = (self._AREAS.index(area) * 99 + group - 1) * 9999 + serial - 1
        x = permute(x, len(self._AREAS) * 99 * 9999, key, self.name, inverse)
        x, serial = divmod(x, 9999)
        area, group = divmod(x, 99)
        return f"{self._AREAS[area]:03d}-{group + 1:02d}-{serial + 1:04d}"


class Phone(Kind):
    """North American number, with or without +1.

    After +1, or 1 and parentheses, any area and exchange will do; else both are from 200. The
    two sorts share no value, and each stays within its own.
    """

    name = "phone"
    pattern = r"(?<![\w.])(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-]|\.\d)"
    _ASSIGNED = 800 * 800 * 10_000  # both from 200
    _OTHER = 10**10 - _ASSIGNED

    def valid(self, text: str) -> bool:
        digits = _digits(text)
        d = digits[-10:]
        sure = text[0] == "+" or len(digits) == 11 and "(" in text
        return sure or d[0] in "23456789" and d[3] in "23456789"

    def change(self, text: str, key: bytes, inverse: bool) -> str:
        digits = _digits(text)
        lead, d = digits[:-10], digits[-10:]
        area, exchange, line = int(d[:3]), int(d[3:6]), int(d[6:])
        if area >= 200 and exchange >= 200:
            x = ((area - 200) * 800 + exchange - 200) * 10_000 + line
            x = permute(x, self._ASSIGNED, key, self.name, inverse)
            x, line = divmod(x, 10_000)
            area, exchange = divmod(x, 800)
            return _refill(text, f"{lead}{area + 200}{exchange + 200}{line:04d}")
        # areas under 200 with any exchange, then the others with exchanges under 200
        x = area * 1000 + exchange if area < 200 else 200_000 + (area - 200) * 200 + exchange
        x = permute(x * 10_000 + line, self._OTHER, key, f"{self.name}0", inverse)
        x, line = divmod(x, 10_000)
        area, exchange = divmod(x, 1000) if x < 200_000 else divmod(x - 200_000 + 200 * 200, 200)
        return _refill(text, f"{lead}{area:03d}{exchange:03d}{line:04d}")


class Address4(Kind):
    """Internet address of four numbers from 0 to 255, without leading zeros."""

    name = "ipv4"
    pattern = r"(?<![\w.-])\d{1,3}(?:\.\d{1,3}){3}(?![\w-]|\.\d)"

    def valid(self, text: str) -> bool:
        return all(int(p) < 256 and str(int(p)) == p for p in text.split("."))

    def change(self, text: str, key: bytes, inverse: bool) -> str:
        x = int.from_bytes(bytes(map(int, text.split("."))), "big")
        return ".".join(map(str, permute(x, 1 << 32, key, self.name, inverse).to_bytes(4, "big")))


_FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2100, 1, 1).toordinal() - _FIRST_DAY


class Date(Kind):
    """A day from 1900 to 2099: year-month-day, or day and month first, by one separator.

    With the year last the day is read as day/month/year where that is a date, else as
    month/day/year; day and month have one or two digits. A time may follow after a T.

    One day has one pseudonym in every layout. So that each layout can hold it, a day is permuted
    among those that are written alike: its month keeps its number of digits, its day of the
    month stays below 10, from 10 to 12, or above (only such days are read month first). The
    fewest such days are 1,800, of the 10th to 12th of the last three months.
    """

    name = "date"
    pattern = (
        r"(?<![\w.:/-])(?:\d{4}([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([-/.])\d{1,2}\2\d{4})"
        r"(?:(?=T\d\d)|(?![\w-]|[./]\d))"
    )

    def _read(self, text: str) -> tuple[str, datetime.date] | None:
        parts = list(map(int, re.split(r"[-/.]", text)))
        orders = [("ymd", parts)] if parts[0] > 999 else [
            ("dmy", parts[::-1]), ("mdy", [parts[2], parts[0], parts[1]])
        ]
        for order, (y, m, d) in orders:
            try:
                day = datetime.date(y, m, d)
            except ValueError:
                continue
            if 1900 <= y < 2100:
                return order, day
        return None

    def valid(self, text: str) -> bool:
        return self._read(text) is not None

    def change(self, text: str, key: bytes, inverse: bool) -> str:
        order, day = self._read(text)
        sign = re.search(r"[-/.]", text)[0]
        sizes = [len(p) for p in re.split(r"[-/.]", text)]
        x, alike = day.toordinal() - _FIRST_DAY, self._alike(day)
        while True:  # on until the pseudonym is written like the day
            x = permute(x, _DAYS, key, self.name, inverse)
            day = datetime.date.fromordinal(x + _FIRST_DAY)
            if self._alike(day) == alike:
                parts = {"y": day.year, "m": day.month, "d": day.day}
                return sign.join(f"{parts[p]:0{n}d}" for p, n in zip(order, sizes, strict=True))

    @staticmethod
    def _alike(day: datetime.date) -> tuple[bool, bool, bool]:
        return day.month < 10, day.day < 10, day.day > 12


class Iban(Kind):
    """International account number with valid check digits; country and letters' places stay.

    One of its country's length is found before whatever follows it, one of another country
    up to the last border between groups where its check digits are right.
    """

    name = "iban"
    #: Characters by country, of the registry of ISO 13616.
    _LENGTHS = {c: int(n) for n, countries in (
        row.split(":") for row in (
            "15:NO", "16:BE", "18:DK FI FK FO GL NL SD", "19:MK SI", "20:AT BA EE KZ LT LU MN XK",
            "21:CH HR LI LV", "22:BG BH CR DE GB GE IE ME RS", "23:AE GI IL IQ OM SO TL",
            "24:AD CZ ES MD PK RO SA SE SK TN VG", "25:LY PT ST", "26:IS TR", "27:BI DJ FR GR IT MC MR SM",
            "28:AL AZ BY CY DO GT HN HU LB NI PL SV", "29:BR EG PS QA UA", "30:JO KW MU YE", "31:MT SC",
            "32:LC", "33:RU",
        )
    ) for c in countries.split()}
    pattern = r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}(?!\w)"

    @staticmethod
    def _check(country: str, body: str) -> str:
        number = "".join(str(int(c, 36)) for c in body + country + "00")
        return f"{98 - int(number) % 97:02d}"

    def valid(self, text: str) -> bool:
        plain = text.replace(" ", "")
        return plain[2:4] == self._check(plain[:2], plain[4:])

    def size(self, text: str) -> int:
        ends = [m.start() for m in re.finditer(" ", text)] + [len(text)]
        length = self._LENGTHS.get(text[:2])
        own = [e for e in ends if e - text.count(" ", 0, e) == length]
        others = [e for e in reversed(ends) if length is None and e - text.count(" ", 0, e) >= 15]
        for end in own + [len(text)] + others:
            if self.valid(text[:end]):
                return end
        return 0

    def change(self, text: str, key: bytes, inverse: bool) -> str:
        plain = text.replace(" ", "")
        country, body = plain[:2], plain[4:]
        bases = [10 if c.isdigit() else 26 for c in body]
        x, n = 0, 1
        for c, base in zip(body, bases, strict=True):
            x, n = x * base + (int(c) if base == 10 else ord(c) - 65), n * base
        x = permute(x, n, key, f"iban{country}{''.join('d' if b == 10 else 'l' for b in bases)}", inverse)
        new = []
        for base in reversed(bases):
            x, d = divmod(x, base)
            new.append(str(d) if base == 10 else chr(65 + d))
        made = "".join(reversed(new))
        source = iter(country + self._check(country, made) + made)
        return "".join(c if c == " " else next(source) for c in text)


_LOWER, _UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _letters(text: str, key: bytes, label: str, inverse: bool) -> str:
    """Letters and digits permuted together, each within its class; all else stays."""
    sets = [next((s for s in (_LOWER, _UPPER, "0123456789") if c in s), "") for c in text]
    x, n = 0, 1
    for c, s in zip(text, sets, strict=True):
        if s:
            x, n = x * len(s) + s.index(c), n * len(s)
    form = "".join({26: "a" if s == _LOWER else "A", 10: "0"}.get(len(s), c) for c, s in zip(text, sets, strict=True))
    x = permute(x, n, key, f"{label}{form}", inverse)
    out = []
    for c, s in zip(reversed(text), reversed(sets), strict=True):
        if s:
            x, d = divmod(x, len(s))
            c = s[d]
        out.append(c)
    return "".join(reversed(out))


class Mail(Kind):
    """Mail address: the part before the sign is replaced, the host stays."""

    name = "email"
    pattern = r"(?<![\w.+%-])[\w.+%-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![\w-])"

    def valid(self, text: str) -> bool:
        return any(c in _LOWER or c in _UPPER or c.isdecimal() and c in "0123456789" for c in text.split("@")[0])

    def change(self, text: str, key: bytes, inverse: bool) -> str:
        own, _, host = text.rpartition("@")
        return f"{_letters(own, key, self.name, inverse)}@{host}"


class Secret(Kind):
    """Access keys by their fixed beginnings, and values given to a password or the like.

    A value follows its name on the same line, after ``=``, ``:``, ``:=``, ``==`` or ``=>``, with or
    without blanks and quotes. Quoted, it goes on to the closing quote.
    """

    name = "secret"
    _GIVEN = (
        r"(?i:(?:password|passwd|pwd|secret|token|api[_-]?key)(?:\\?[\"'])?[^\S\r\n]*(?:=>|:=|==?|:)[^\S\r\n]*)"
    )
    pattern = (
        r"(?<!\w)(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_\w{20,}|sk-[\w-]{16,}|xox[abprs]-[\w-]{10,})(?!\w)"
        rf"|(?<![A-Za-z]){_GIVEN}"
        r"(?:\\?\"[^\"\r\n]{3,200}?[^\"\\\r\n](?=\\?\")|\\?'[^'\r\n]{3,200}?[^'\\\r\n](?=\\?')"
        r"|(?:\\?[\"'])?[^\s\"',;]{3,}[A-Za-z0-9])"
    )
    _KEPT = re.compile(rf"AKIA|ASIA|gh[pousr]_|sk-|xox[abprs]-|{_GIVEN}(?:\\?[\"'])?")

    def own(self, text: str) -> int:
        """Where the part to replace begins."""
        return self._KEPT.match(text).end()

    def is_given(self, text: str) -> bool:
        """Whether a name stands before the value."""
        return text[self.own(text) - 1] not in "A_-"

    def valid(self, text: str) -> bool:
        return sum(c in _LOWER or c in _UPPER or c in "0123456789" for c in text[self.own(text) :]) >= 4

    def change(self, text: str, key: bytes, inverse: bool) -> str:
        at = self.own(text)
        return text[:at] + _letters(text[at:], key, self.name, inverse)


KINDS: list[Kind] = [Mail(), Secret(), Iban(), Card(), Social(), Phone(), Address4(), Date()]
_BY_NAME = {k.name: k for k in KINDS}


def _numbered(pattern: str, before: int) -> str:
    """Back references of a pattern that follows ``before`` groups."""
    return re.sub(r"\\(\d)", lambda m: f"\\{int(m[1]) + before}", pattern)


def _join(kinds: list[Kind]) -> re.Pattern:
    parts, groups = [], 0
    for kind in kinds:
        groups += 1
        parts.append(f"(?P<{kind.name}>{_numbered(kind.pattern, groups)})")
        groups += re.compile(kind.pattern).groups
    return re.compile("|".join(parts))


# ---------------------------------------------------------------- whole texts


class Pseudonymizer:
    """Finds and replaces the values of one text; remembers the latest pseudonyms."""

    def __init__(self, key: bytes, kinds: list[str] | None = None, inverse: bool = False):
        self._kinds = [k for k in KINDS if kinds is None or k.name in kinds]
        self._pattern = _join(self._kinds)
        self._change: Callable[[str, str], str] = lru_cache(1 << 16)(
            lambda kind, text: _BY_NAME[kind].change(text, key, inverse)
        )

    def find(self, text: str) -> Iterator[tuple[int, int, str]]:
        """(start, end, kind) of each valid value; one that is not valid is passed over."""
        at = 0
        while match := self._pattern.search(text, at):
            start = match.start()
            kind = match.lastgroup or next(k for k, v in match.groupdict().items() if v is not None)
            size = _BY_NAME[kind].size(match[0])
            if size:
                found = (kind == "secret" and self._given(text, match)) or (start, start + size, kind)
            else:
                found = self._other(text, start)
            if found:
                yield found
            at = found[1] if found else start + 1

    def _given(self, text: str, match: re.Match) -> tuple[int, int, str] | None:
        """The value given to a name if it is an access key, or one of another kind that ends later."""
        secret = _BY_NAME["secret"]
        if not secret.is_given(match[0]):
            return None
        other = self._other(text, match.start() + secret.own(match[0]))
        if other and (other[1] > match.end() or other[1] == match.end() and other[2] == "secret"):
            return other
        return None

    def _other(self, text: str, start: int) -> tuple[int, int, str] | None:
        """A valid value of any kind that begins at ``start``."""
        for kind in self._kinds:
            match = re.compile(kind.pattern).match(text, start)
            size = kind.size(match[0]) if match else 0
            if size:
                return start, start + size, kind.name
        return None

    def replace(self, text: str) -> tuple[str, list[tuple[int, int, str]]]:
        """The text with pseudonyms, and where they stand in it."""
        out, spans, at, size = [], [], 0, 0
        for start, end, kind in self.find(text):
            new = self._change(kind, text[start:end])
            out += [text[at:start], new]
            size += start - at
            spans.append((size, size + len(new), kind))
            size += len(new)
            at = end
        return "".join([*out, text[at:]]) if spans else text, spans


_SPANS = "array<struct<start: int, end: int, kind: string>>"


def pseudonymize(
    docs: DataFrame, key: str, kinds: list[str] | None = None, inverse: bool = False,
    spans_col: str = "spans",
) -> DataFrame:
    """All columns of ``docs`` with ``text`` replaced, and ``spans_col``: the pseudonyms in it.

    ``kinds`` limits which of :data:`KINDS` are replaced; ``inverse`` turns pseudonyms made with
    the same key back. A NULL text stays NULL and an empty one empty, without spans; repeated
    rows stay; an input column of the name of ``spans_col``, in any case, is replaced; an empty
    table gives an empty result. Very long texts are searched whole.
    No rows are shuffled, and what a document becomes depends on it and the key alone.
    """
    secret = hashlib.blake2b(key.encode(), digest_size=32).digest()
    carried = [c for c in docs.columns if c.lower() not in ("text", spans_col.lower())]
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = Pseudonymizer(secret, kinds, inverse)
        for batch in small_batches(batches, 500):
            made = [(None, []) if t is None else worker.replace(t) for t in batch.column("text").to_pylist()]
            spans = [[{"start": s, "end": e, "kind": k} for s, e, k in x] for _, x in made]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in carried), pa.array([t for t, _ in made], pa.string()),
                 pa.array(spans, span)],
                [*carried, "text", spans_col],
            )

    kinds_of = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join([*(f"`{c}` {kinds_of[c]}" for c in carried), "text string", f"`{spans_col}` {_SPANS}"])
    return docs.select(*carried, "text").mapInArrow(run, schema)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with pseudonyms in place of personal data."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymize(docs, key="registered query").select(
        "doc_id", "text", F.size("spans").alias("n_replaced"), "spans"
    )
