"""Personal data replaced by format-preserving pseudonyms.

Numbers and dates that prove valid (checksums, number ranges, calendar) are permuted by
a keyed Feistel network within the values of their own format; a result that would not
be valid is permuted again until it is (cycle walking).  So a pseudonym is valid where
the original was, keeps its punctuation, and equal values get equal pseudonyms in every
document.  Key and spans lead back (`revealed`), whatever stands beside a value.  Mail names,
which are words over an alphabet, are permuted the same way.

Each text is handled by itself: no shuffle, and nothing depends on other rows.
"""

from __future__ import annotations

import datetime
import hashlib
import hmac
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ROW, text_batches, with_row_id

ROUNDS = 8
BATCH_BYTES = 16 << 20


class Feistel:
    """A keyed permutation of the numbers below any size, by cycle walking."""

    def __init__(self, key: bytes):
        self.key = key

    def _round(self, tweak: str, number: int, value: int, size: int) -> int:
        message = f"{tweak}|{size}|{number}|{value}".encode()
        return int.from_bytes(hmac.digest(self.key, message, hashlib.sha256), "big") % size

    def _once(self, tweak: str, value: int, left: int, right: int, back: bool) -> int:
        # Halves of sizes left and right; each round adds a keyed function of one to the other.
        a, b = divmod(value, right)
        for number in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if number % 2 == 0:
                a = (a + sign * self._round(tweak, number, b, left)) % left
            else:
                b = (b + sign * self._round(tweak, number, a, right)) % right
        return a * right + b

    def permuted(self, tweak: str, value: int, size: int, back: bool = False, valid: Callable[[int], bool] | None = None) -> int:
        """Where the permutation of [0, size) takes a value, within those that are valid."""
        left = 1
        while left * left < size:
            left *= 2
        right = -(-size // left)
        while True:
            value = self._once(tweak, value, left, right, back)
            if value < size and (valid is None or valid(value)):
                return value


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _with_check_digit(payload: str) -> str:
    return next(payload + c for c in "0123456789" if luhn(payload + c))


def _iban_ok(text: str) -> bool:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97 == 1


def _iban(country: str, body: str) -> str:
    rest = int("".join(str(int(c, 36)) for c in body + country + "00")) % 97
    return f"{country}{98 - rest:02d}{body}"


# Lengths by country; others may have any from 15 to 34.
_IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
        21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}


class Kind(NamedTuple):
    name: str
    pattern: str
    end: str  # what must hold where the value ends
    change: Callable[[Feistel, re.Match | str, bool], str | None]  # None: not valid, leave it


def _digits_of(text: str) -> str:
    return re.sub(r"\D", "", text)


def _filled(text: str, digits: str) -> str:
    """The text with its digits replaced in order."""
    new = iter(digits)
    return re.sub(r"\d", lambda _: next(new), text)


def _card(f: Feistel, text: str, back: bool) -> str | None:
    digits = _digits_of(text)
    if not 13 <= len(digits) <= 19 or digits[0] == "0" or not luhn(digits):
        return None
    payload = digits[:-1]
    # The leading digit keeps the kind of card.
    value = f.permuted(f"card{digits[0]}", int(payload[1:]), 10 ** (len(payload) - 1), back)
    return _filled(text, _with_check_digit(payload[0] + f"{value:0{len(payload) - 1}d}"))


def _iban_kind(f: Feistel, text: str, back: bool) -> str | None:
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or len(plain) != _IBAN_LENGTHS.get(plain[:2], len(plain)) or not _iban_ok(plain):
        return None
    body, alphabets = plain[4:], []
    value, size = 0, 1
    for c in body:
        alphabet = "0123456789" if c.isdigit() else "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        alphabets.append(alphabet)
        value, size = value * len(alphabet) + alphabet.index(c), size * len(alphabet)
    shape = "".join("d" if len(a) == 10 else "l" for a in alphabets)
    value = f.permuted(f"iban{plain[:2]}{shape}", value, size, back)
    out = []
    for alphabet in reversed(alphabets):
        value, k = divmod(value, len(alphabet))
        out.append(alphabet[k])
    new = iter(_iban(plain[:2], "".join(reversed(out))))
    return re.sub(r"[A-Z0-9]", lambda _: next(new), text)


def _ssn_ok(n: int) -> bool:
    area, group, serial = n // 1_000_000, n // 10_000 % 100, n % 10_000
    return 0 < area < 900 and area != 666 and group > 0 and serial > 0


def _ssn(f: Feistel, text: str, back: bool) -> str | None:
    n = int(_digits_of(text))
    if not _ssn_ok(n):
        return None
    return _filled(text, f"{f.permuted('ssn', n, 10**9, back, _ssn_ok):09d}")


def _phone(f: Feistel, text: str, back: bool) -> str | None:
    digits = _digits_of(text)
    if not 8 <= len(digits) <= 15:
        return None
    # The country code, a plus sign's first digit, stays.
    keep = 1 if text.startswith("+") else 0
    rest = digits[keep:]
    value = f.permuted(f"phone{digits[:keep]}", int(rest), 10 ** len(rest), back)
    return _filled(text, digits[:keep] + f"{value:0{len(rest)}d}")


def _ip_ok(text: str) -> bool:
    return all(int(p) <= 255 and (len(p) == 1 or p[0] != "0") for p in text.split("."))


# Smallest number and how many there are, by the number's length.
_IP_RANGES = {1: (0, 10), 2: (10, 90), 3: (100, 156)}


def _ip(f: Feistel, text: str, back: bool) -> str | None:
    if not _ip_ok(text):
        return None
    # The lengths of the four numbers stay, so the permutation is one of such addresses only.
    ranges = [_IP_RANGES[len(p)] for p in text.split(".")]
    rank = size = 0
    for number, (first, count) in zip(map(int, text.split(".")), ranges):
        rank, size = rank * count + number - first, max(size, 1) * count
    rank = f.permuted("ip" + ".".join(str(len(p)) for p in text.split(".")), rank, size, back)
    numbers = []
    for first, count in reversed(ranges):
        rank, number = divmod(rank, count)
        numbers.append(str(first + number))
    return ".".join(reversed(numbers))


_FIRST_DAY = datetime.date(1900, 1, 1).toordinal()
_DAYS = datetime.date(2100, 1, 1).toordinal() - _FIRST_DAY


def _date(f: Feistel, text: str, back: bool) -> str | None:
    parts = re.split(r"[-/.]", text)
    numbers = [int(p) for p in parts]
    # Slash dates that end in the year are month-first where both readings are dates.
    orders = [(0, 1, 2)] if len(parts[0]) == 4 else [(2, 1, 0)] if "/" not in text else [(2, 0, 1), (2, 1, 0)]
    for order in orders:
        try:
            day = datetime.date(*(numbers[i] for i in order)).toordinal() - _FIRST_DAY
            break
        except ValueError:
            continue
    else:
        return None
    if not 0 <= day < _DAYS:
        return None

    def same(n: int) -> bool:
        """A day-first slash date stays one that cannot be read month-first."""
        return order == orders[0] or datetime.date.fromordinal(_FIRST_DAY + n).day > 12

    new = datetime.date.fromordinal(_FIRST_DAY + f.permuted("date", day, _DAYS, back, same))
    values = dict(zip(order, (new.year, new.month, new.day)))
    fresh = iter(f"{values[i]:0{4 if i == order[0] else 2}d}" for i in range(3))
    return re.sub(r"\d+", lambda _: next(fresh), text)


_NAME = "abcdefghijklmnopqrstuvwxyz"


def _mail(f: Feistel, text: str, back: bool) -> str | None:
    """The name and the host's first labels, letters for letters and digits for digits."""
    name, _, host = text.partition("@")
    top = host.rsplit(".", 1)[1]
    out = []
    for part, label in ((name, "name"), (host[: -len(top) - 1], "host")):
        sizes = [26 if c.isalpha() else 10 if c.isdigit() else 1 for c in part]
        low = part.lower()
        value, size = 0, 1
        for c, n in zip(low, sizes):
            value, size = value * n + (_NAME.index(c) if n == 26 else int(c) if n == 10 else 0), size * n
        shape = "".join("l" if n == 26 else "d" if n == 10 else c for c, n in zip(part, sizes))
        if size > 1:
            value = f.permuted(f"mail{label}{shape}", value, size, back)
        new = []
        for c, n in zip(reversed(part), reversed(sizes)):
            value, k = divmod(value, n)
            new.append(c if n == 1 else str(k) if n == 10 else _NAME[k].upper() if c.isupper() else _NAME[k])
        out.append("".join(reversed(new)))
    return f"{out[0]}@{out[1]}.{top}"


# Formats of personal data, the more specific first.
KINDS = [
    Kind("email", r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}", r"\b", _mail),
    Kind("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?", r"\b", _iban_kind),
    Kind("date", r"(?<![\w./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}-\d{2}-\d{4}|\d{2}/\d{2}/\d{4})", r"(?:(?=T\d)|(?![\w/-]))", _date),
    Kind("ip", r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}", r"(?!\.?\w)", _ip),
    Kind("ssn", r"(?<![\w-])\d{3}-\d{2}-\d{4}", r"(?![\w-])", _ssn),
    Kind("card", r"(?<![\w.-])\d(?:[ -]?\d){12,18}", r"(?![\w-])", _card),
    Kind("phone", r"(?:(?<![\w.])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}|(?<![\w.])\(\d{3}\) ?\d{3}[ .-]?\d{4}|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?!-))", r"(?!\w)", _phone),
]

_ANY = re.compile("|".join(f"{k.pattern}{k.end}" for k in KINDS), re.ASCII)
_MARK = re.compile("[0-9@]")  # no kind does without
_WHOLE = {k.name: re.compile(k.pattern + k.end, re.ASCII) for k in KINDS}
_BODY = {k.name: re.compile(k.pattern, re.ASCII) for k in KINDS}
_END = {k.name: re.compile(k.end, re.ASCII) for k in KINDS}
_BORDER = re.compile(r"(?<=[A-Z0-9])[ .-]", re.ASCII)
_NEAR = re.compile("[A-Z0-9+(]")
_REACH = 48  # no number is longer


def _ends(kind: Kind, text: str, start: int, feistel: Feistel) -> Iterator[int]:
    """Where a value of the kind may end that begins at `start`, the longest first."""
    found = _WHOLE[kind.name].match(text, start)
    if not found:
        return
    if kind.name not in ("iban", "card", "phone"):
        yield found.end()
        return
    borders = [m.start() for m in _BORDER.finditer(text, start, found.end())]
    ends = [found.end()] + [
        e for e in reversed(borders) if _BODY[kind.name].fullmatch(text, start, e) and _END[kind.name].match(text, e)
    ]
    if kind.name != "iban":
        # It ends before a date or address that follows.
        for border in borders:
            if text[border] == " ":
                day, address = (_WHOLE[name].match(text, border + 1) for name in ("date", "ip"))
                if address and _ip_ok(address[0]) or day and _date(feistel, day[0], False):
                    ends = [e for e in ends if e <= border]
    if kind.name == "phone" and text[start : start + 2] in ("+1", "+7"):
        # Numbers of these countries have eleven digits.
        ends.sort(key=lambda e: len(_digits_of(text[start:e])) != 11)
    yield from ends


def _next(text: str, at: int, feistel: Feistel, back: bool) -> tuple[Kind, int, int, str] | None:
    """The next value from `at` on: (kind, start, end, replacement)."""
    while found := _ANY.search(text, at):
        start = found.start()
        for kind in KINDS:
            for end in _ends(kind, text, start, feistel):
                new = kind.change(feistel, text[start:end], back)
                if new is not None:
                    return kind, start, end, new
        at = start + 1
    return None


def replaced(
    text: str, key: bytes, back: bool = False, linked: bool = False
) -> tuple[str, list[tuple[str, int, int]]]:
    """(the text with pseudonyms, their (kind, start, end) in both texts, which are of one length).

    `linked`, equal values get equal pseudonyms wherever they stand, and `restored` leads back.
    Otherwise one that a number beside it would make read differently is permuted again, so
    that `back` may find it in the text alone.
    """
    if not _MARK.search(text):
        return text, []
    feistel, spans, out, done = Feistel(key), [], [], 0
    while found := _next(text, done, feistel, back):
        kind, start, end, new = found
        if not linked and _NEAR.search(text[max(start - 2, done) : start] + text[end : end + 2]):
            # A number stands beside it: go on until the pseudonym is read as the value was.
            low = max(done, start - _REACH)
            lead, tail = text[max(low - 1, 0) : start], text[end : end + _REACH]

            def fits(value: str) -> bool:
                again = _next(lead + value + tail, low - max(low - 1, 0), feistel, back)
                return again is not None and (again[0], again[1], again[2]) == (kind, len(lead), len(lead) + len(value))

            if fits(text[start:end]):
                while not fits(new):
                    new = kind.change(feistel, new, back)
        out += [text[done:start], new]
        spans.append((kind.name, start, end))
        done = end
    return "".join([*out, text[done:]]), spans


def restored(text: str, spans: list[tuple[str, int, int]], key: bytes) -> str:
    """The original of a text with `linked` pseudonyms at the given spans."""
    feistel, kinds, out, done = Feistel(key), {k.name: k for k in KINDS}, [], 0
    for name, start, end in spans:
        value = kinds[name].change(feistel, text[start:end], True)
        if value is None:
            raise ValueError(f"no {name} stands at {start} to {end}")
        out += [text[done:start], value]
        done = end
    return "".join([*out, text[done:]])


_OUT = "text string, n_values bigint, kinds array<string>, starts array<bigint>, ends array<bigint>"


def pseudonymised(
    docs: DataFrame, key: bytes, id_column: str = "doc_id", text_column: str = "text", back: bool = False
) -> DataFrame:
    """One row per document: (_row_id, doc_id, text, n_values, kinds, starts, ends).

    `text` has all personal values replaced; kinds, starts and ends tell what they were
    and where they stand in the original and here, by character.  A text without any comes
    back unchanged, NULL as NULL.  An empty table gives an empty result; other columns are
    ignored.  Equal values have equal pseudonyms in all texts, beside any neighbour; `revealed`
    turns them back.  `back=True` looks for pseudonyms in texts whose spans are lost; it may
    miss those beside another number.
    """
    rows = with_row_id(docs).select(
        ROW, F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("_text")
    )
    ids = rows.schema["doc_id"].dataType.simpleString()

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, 2, BATCH_BYTES):
            texts, spans = [], []
            for text in batch.column(2).to_pylist():
                new, found = replaced(text, key, back, linked=True) if text else (text, [])
                texts.append(new)
                spans.append(found)
            columns = [[[s[k] for s in own] for own in spans] for k in range(3)]
            yield pa.record_batch(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(texts, pa.string()),
                    pa.array([len(s) for s in spans], pa.int64()),
                    pa.array(columns[0], pa.list_(pa.string())),
                    pa.array(columns[1], pa.list_(pa.int64())),
                    pa.array(columns[2], pa.list_(pa.int64())),
                ],
                names=[ROW, "doc_id", "text", "n_values", "kinds", "starts", "ends"],
            )

    return rows.mapInArrow(run, f"{ROW} bigint, doc_id {ids}, {_OUT}")


def revealed(found: DataFrame, key: bytes) -> DataFrame:
    """The rows that `pseudonymised` gave, with the original texts; all columns are kept.

    NULL texts, and texts without spans (empty or NULL), stay as they are.  A span that
    holds no value of its kind is an error.  An empty table gives an empty result.
    """
    columns = found.columns
    at, *places = [columns.index(c) for c in ("text", "kinds", "starts", "ends")]

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, at, BATCH_BYTES):
            spans = [[own or [] for own in batch.column(k).to_pylist()] for k in places]
            texts = [
                None if text is None else restored(text, list(zip(*own)), key)
                for text, *own in zip(batch.column(at).to_pylist(), *spans)
            ]
            yield pa.record_batch(
                [pa.array(texts, pa.string()) if k == at else batch.column(k) for k in range(len(columns))],
                names=columns,
            )

    return found.mapInArrow(run, found.schema)
