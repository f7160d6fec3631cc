"""Personal data replaced by format-preserving pseudonyms from a keyed Feistel permutation."""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tenura.llm.arrow import slices

ROUNDS = 8
#: Characters that stand for each other; any other character of a value stays as it is.
CLASSES = (
    "0123456789",
    "abcdefghijklmnopqrstuvwxyz",
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7),
    "".join(chr(c) for c in range(0xC0, 0xDF) if c != 0xD7),
)
CLASS_OF = {c: k for k, chars in enumerate(CLASSES) for c in chars}
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()
# Lengths of an IBAN by country.
IBAN_LENGTHS = {
    "AD": 24, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18,
    "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21,
    "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19, "SK": 24,
    "AE": 23, "AL": 28, "AZ": 28, "BA": 20, "BH": 22, "BI": 27, "BR": 29, "BY": 28, "CR": 22, "DJ": 27, "DO": 28, "EG": 29,
    "FK": 18, "FO": 18, "GE": 22, "GI": 23, "GL": 18, "GT": 28, "HN": 28, "IL": 23, "IQ": 23, "JO": 30, "KW": 30, "KZ": 20,
    "LB": 28, "LC": 32, "LY": 25, "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MU": 30, "NI": 28, "OM": 23, "PK": 24,
    "PS": 29, "QA": 29, "RS": 22, "RU": 33, "SA": 24, "SC": 31, "SD": 18, "SM": 27, "SO": 23, "ST": 25, "SV": 28, "TL": 23,
    "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}

PATTERNS = {
    "email": r"(?<![\w.+-])[\w.+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![\w-])",
    "secret": r"(?i:\b(?:token|secret|password|passwd|api[_-]?key)\b)\s{0,8}[=:]\s{0,8}[\"']?(?P<hex>[0-9A-Fa-f]{16,})(?![0-9A-Za-z])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{1,4}){3,8}(?![A-Za-z0-9])",
    "ip": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)",
    "iso": r"(?<![\d-])\d{4}(?P<iso_sep>[-/.])\d{2}(?P=iso_sep)\d{2}(?![\d-])",
    "date": r"(?<![\d/.-])\d{1,2}(?P<date_sep>[-/.])\d{1,2}(?P=date_sep)\d{4}(?![\d/-])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\w+])\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
    r"|(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)"
    r"|(?<![\w(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)"
    r"|(?<![\w.-])\d{3}(?P<phone_sep>[ .-])\d{3}(?P=phone_sep)\d{4}(?![\w-])",
    "card": r"(?<![\w.-])(?:\d{13,19}|\d{4}[ -]\d{6}[ -]\d{5}|\d{4}(?:[ -]\d{4}){2,3}(?:[ -]\d{1,4})?)(?![\w-])",
}
ANY = re.compile("|".join(f"(?P<{name}>{pattern})" for name, pattern in PATTERNS.items()))
KINDS = tuple(PATTERNS)
#: Every value holds one of these characters, and at most this many others lie between two or outside them
#: besides what is joined to them without a blank.
ANCHOR = re.compile(r"[0-9@]+")
MARGIN = 48
BLANK = re.compile(r"\s")


class Permutation:
    """Keyed permutations of the whole numbers below any bound.

    Numbers are split in two halves of nearly equal range that take turns in adding a keyed hash of the
    other; a result beyond the bound goes through again, which keeps the map one-to-one.
    """

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _draw(self, tweak: str, turn: int, half: int, bound: int) -> int:
        text = f"{tweak}|{turn}|{half}".encode()
        return int.from_bytes(hashlib.blake2b(text, key=self.key, digest_size=32).digest(), "big") % bound

    def __call__(self, value: int, bound: int, tweak: str) -> int:
        if bound < 2:
            return value
        low = math.isqrt(bound - 1) + 1
        high = -(-bound // low)
        tweak = f"{tweak}|{bound}"
        while True:
            a, b = divmod(value, low)
            for turn in range(ROUNDS):
                if turn % 2:
                    a = (a + self._draw(tweak, turn, b, high)) % high
                else:
                    b = (b + self._draw(tweak, turn, a, low)) % low
            value = a * low + b
            if value < bound:
                return value


def permute_text(permute: Permutation, text: str, tweak: str) -> str:
    """Letters and digits permuted together, each staying in its class; all else stays."""
    value, bound = 0, 1
    for c in text:
        if c in CLASS_OF:
            size = len(CLASSES[CLASS_OF[c]])
            value, bound = value * size + CLASSES[CLASS_OF[c]].index(c), bound * size
    shape = "".join(str(CLASS_OF.get(c, "-")) for c in text)
    value = permute(value, bound, f"{tweak}|{shape}")
    out = []
    for c in reversed(text):
        if c in CLASS_OF:
            chars = CLASSES[CLASS_OF[c]]
            value, place = divmod(value, len(chars))
            c = chars[place]
        out.append(c)
    return "".join(reversed(out))


def permute_digits(permute: Permutation, digits: str, tweak: str) -> str:
    return str(permute(int(digits), 10 ** len(digits), tweak)).zfill(len(digits)) if digits else digits


def _refill(pattern: str, digits: str) -> str:
    """``pattern`` with its digits replaced in order."""
    source = iter(digits)
    return "".join(next(source) if c.isascii() and c.isdigit() else c for c in pattern)


def luhn_digit(digits: str) -> str:
    """The check digit that follows these digits."""
    total = 0
    for place, c in enumerate(reversed(digits)):
        twice = int(c) * 2 if place % 2 == 0 else int(c)
        total += twice - 9 if twice > 9 else twice
    return str(-total % 10)


def _card(permute: Permutation, text: str) -> str | None:
    digits = re.sub(r"\D", "", text)
    if luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    body = digits[0] + permute_digits(permute, digits[1:-1], f"card{digits[0]}")
    return _refill(text, body + luhn_digit(body))


def _iban_check(country: str, body: str) -> str:
    number = "".join(str(int(c, 36)) for c in f"{body}{country}00")
    return f"{98 - int(number) % 97:02d}"


def _iban(permute: Permutation, text: str) -> str | None:
    plain = text.replace(" ", "")
    country, body = plain[:2], plain[4:]
    if IBAN_LENGTHS.get(country) != len(plain) or _iban_check(country, body) != plain[2:4]:
        return None
    body = permute_text(permute, body, f"iban{country}")
    source = iter(country + _iban_check(country, body) + body)
    return "".join(c if c == " " else next(source) for c in text)


def _ip(permute: Permutation, text: str) -> str | None:
    parts = [int(x) for x in text.split(".")]
    if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in text.split(".")):
        return None
    number = permute(int.from_bytes(bytes(parts), "big"), 1 << 32, "ip")
    return ".".join(str(b) for b in number.to_bytes(4, "big"))


def _day(permute: Permutation, year: int, month: int, day: int) -> dt.date | None:
    try:
        number = dt.date(year, month, day).toordinal()
    except ValueError:
        return None
    if not FIRST_DAY <= number <= LAST_DAY:
        return None
    return dt.date.fromordinal(FIRST_DAY + permute(number - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, "date"))


def _iso(permute: Permutation, text: str) -> str | None:
    sep = text[4]
    found = _day(permute, *map(int, text.split(sep)))
    return found and found.strftime(f"%Y{sep}%m{sep}%d")


def _date(permute: Permutation, text: str) -> str | None:
    """Day, month, year; month first only if the other way is no date."""
    sep = re.search(r"\D", text).group()
    first, second, year = map(int, text.split(sep))
    swap = second > 12
    found = _day(permute, year, *((first, second) if swap else (second, first)))
    if found is None:
        return None
    values = (found.month, found.day) if swap else (found.day, found.month)
    if swap and found.day <= 12:  # would read as the other order
        later = _day(permute, found.year, found.month, found.day)
        for _ in range(64):
            if later is None or later.day > 12:
                break
            later = _day(permute, later.year, later.month, later.day)
        found = later or found
        values = (found.month, found.day)
    return f"{values[0]:02d}{sep}{values[1]:02d}{sep}{found.year}"


def _ssn(permute: Permutation, text: str) -> str | None:
    area, group, serial = map(int, text.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    areas = [*range(1, 666), *range(667, 900)]
    number = (areas.index(area) * 99 + group - 1) * 9999 + serial - 1
    number = permute(number, len(areas) * 99 * 9999, "ssn")
    rest, serial = divmod(number, 9999)
    area, group = divmod(rest, 99)
    return f"{areas[area]:03d}-{group + 1:02d}-{serial + 1:04d}"


def _phone(permute: Permutation, text: str) -> str | None:
    digits = re.sub(r"\D", "", text)
    if not 8 <= len(digits) <= 15:
        return None
    kept = len(re.match(r"\+?(\d{0,3})", text).group(1)) if text[0] == "+" and not text[1:].isdigit() else int(text[0] == "+")
    return _refill(text, digits[:kept] + permute_digits(permute, digits[kept:], f"phone{digits[:kept]}"))


def _email(permute: Permutation, text: str) -> str | None:
    name, _, ending = text.rpartition(".")
    return f"{permute_text(permute, name, 'email')}.{ending}"


def _secret(permute: Permutation, text: str) -> str:
    number = permute(int(text, 16), 16 ** len(text), "secret")
    made = f"{number:0{len(text)}x}"
    return made.upper() if text.isupper() else made


MAKERS: dict[str, Callable[[Permutation, str], str | None]] = {
    "email": _email, "secret": _secret, "iban": _iban, "ip": _ip, "iso": _iso, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card,
}


def stretches(text: str) -> Iterator[tuple[int, int]]:
    """The parts of a text in which a value can lie, whole up to the next blanks."""
    begin = end = None
    for m in ANCHOR.finditer(text):
        if end is not None and m.start() - end > 2 * MARGIN:
            yield begin, end
            begin = None
        elif end is not None and m.end() <= end:
            continue
        if begin is None:
            start = m.start()
            blank = max(text.rfind(" ", 0, start), text.rfind("\n", 0, start))
            begin = max(0, blank - MARGIN)
        after = BLANK.search(text, min(len(text), m.end() + MARGIN))
        end = after.start() if after else len(text)
    if begin is not None:
        yield begin, end


class Pseudonyms:
    def __init__(self, key: bytes):
        permute = Permutation(key)

        @lru_cache(maxsize=50_000)
        def make(kind: str, value: str) -> str | None:
            return MAKERS[kind](permute, value)

        self.make = make

    def replace(self, text: str) -> tuple[str, list[tuple[str, int, int]]]:
        """The new text, and kind, place and length in it of each pseudonym."""
        out, spans, done, size = [], [], 0, 0
        for begin, end in stretches(text):
            at = max(begin, done)
            while (m := ANY.search(text, at, end)) is not None:
                kind = next(k for k in KINDS if m.group(k) is not None)
                first, last = m.span("hex") if kind == "secret" else m.span()
                new = self.make(kind, text[first:last])
                if new is None:
                    other = self._shorter(text, first, last, kind) or self._other(text, m, kind)
                    if other is None:  # a value may begin behind the first blank of what was none
                        blank = BLANK.search(text, m.start() + 1, m.end())
                        at = blank.start() if blank else m.end()
                        continue
                    kind, first, last, new = other
                out += [text[done:first], new]
                size += first - done
                spans.append((kind, size, len(new)))
                size += len(new)
                done = at = last
        out.append(text[done:])
        return "".join(out), spans

    def _shorter(self, text: str, first: int, last: int, kind: str):
        """A valid value of the kind that ends at an earlier blank: two values may stand side by side."""
        for blank in reversed([m.start() for m in BLANK.finditer(text, first, last)]):
            part = text[first:blank]
            if SINGLE[kind].fullmatch(part) and (new := self.make(kind, part)) is not None:
                return kind, first, blank, new
        return None

    def _other(self, text: str, m: re.Match, kind: str):
        """Another kind that also matches at this place and is valid there."""
        for other in KINDS[KINDS.index(kind) + 1 :]:
            found = SINGLE[other].match(text, m.start())  # looks behind, too
            if found:
                new = self.make(other, found.group())
                if new is not None:
                    return other, *found.span(), new
        return None


SINGLE = {name: re.compile(pattern) for name, pattern in PATTERNS.items()}
SPANS = "array<struct<kind:string,start:int,length:int>>"
SPANS_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("length", pa.int32())]))


def _apply(key: bytes, with_spans: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = Pseudonyms(key)
        for batch in slices(batches, "text"):
            column = batch.column("text")
            found = pc.fill_null(pc.match_substring_regex(column, r"[0-9]|@"), False)
            rows = pc.indices_nonzero(found)
            done = [tool.replace(x) for x in column.take(rows).to_pylist()]
            new = pc.replace_with_mask(column, found, pa.array([x for x, _ in done], column.type))
            place = batch.schema.get_field_index("text")
            batch = batch.set_column(place, batch.schema.field(place), new)
            if with_spans:
                spans: list[list] = [[] for _ in range(batch.num_rows)]
                for row, (_, each) in zip(rows.to_pylist(), done):
                    spans[row] = [{"kind": k, "start": s, "length": n} for k, s, n in each]
                batch = batch.append_column("pii", pa.array(spans, SPANS_ARROW))
            yield batch

    return run


def pseudonymise(docs: DataFrame, key: bytes) -> DataFrame:
    """The documents, with all their columns, whose text has pseudonyms for personal data.

    Found are e-mail addresses, phone numbers in international or North American form, IPv4 addresses, dates from 1900 to 2099, and card, bank
    account and US social security numbers that pass their checks, and hexadecimal secrets behind a name
    such as token. A value becomes another of its format, check digits included, by a permutation that
    depends on ``key`` alone: equal values get equal pseudonyms in all documents and different ones
    different. Numbers that fail their check are left alone, and so are phone numbers in the domestic form
    of other countries, such as those with a trunk 0.

    A null or empty text stays as it is. Repeated rows are treated alike. An empty table gives no rows.
    """
    return docs.mapInArrow(_apply(key, False), docs.schema)


def find_and_replace(docs: DataFrame, key: bytes) -> DataFrame:
    """doc_id, the new text, and ``pii``: kind, start and length in characters of each pseudonym in it.
    Rows and texts are those of `pseudonymise`; other columns are ignored."""
    source = docs.select("doc_id", "text")
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in source.schema)
    return source.mapInArrow(_apply(key, True), f"{kind}, pii {SPANS}")
