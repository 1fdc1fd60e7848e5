"""Personal data replaced by format-preserving pseudonyms.

Numbers and dates are found by their form and checked (check digits, ranges, calendar). Each is mapped
to the number it is among all of its format, moved by a keyed permutation of that range (a Feistel
network, walked on until the result is in the range), and written back in the same format. Equal values
therefore have equal pseudonyms in every document, different ones different pseudonyms, and no table
of values is kept.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from heronry.llm.batches import bounded_batches, pieces

ROUNDS = 8
KINDS = ("email", "iban", "card", "ssn", "phone", "ip", "date", "secret")

_START, _END = "(?<![0-9A-Za-z])", "(?![0-9A-Za-z])"
# The forms of each kind, in the order in which they are looked for: a value found by one is not part of
# a later one.
FORMS = {
    kind: re.compile(f"{_START}(?:{form}){_END}")
    for kind, form in {
        "secret": "[0-9a-f]{32,}|[0-9A-F]{32,}",
        "iban": "[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?",
        "card": r"[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}"
        r"|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}",
        "date": r"[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4}",
        "ip": r"(?<!\.)[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.[0-9])",
        "ssn": "[0-9]{3}-[0-9]{2}-[0-9]{4}(?!-[0-9])",
        "phone": r"\+[0-9]{1,3}[ .-]?\([0-9]{1,4}\)[ .-]?[0-9]{2,4}[ .-]?[0-9]{3,5}"
        r"|\+[0-9]{1,3}(?:[ .-]?\(0\))?(?:[ .-]?[0-9]{2,12}(?!\.?[0-9])){1,4}"
        r"|\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|[0-9]{3}([-.])[0-9]{3}\1[0-9]{4}",
    }.items()
}
EMAIL = re.compile(
    r"(?<![\w.%+-])(?P<local>[\w.%+-]+)@(?P<host>[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})"
)
DIGIT = re.compile("[0-9]")
# Characters of an address that are moved as one number; longer ones, which no mail server takes, in parts.
LOCAL_PART = 256
OPTIONAL_ZERO = re.compile(r"[ .-]?\(0\)")
# Country codes of two digits in the public numbering plan. 1 and 7 are codes by themselves, and
# all others have three digits.
TWO_DIGIT_COUNTRIES = set(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66"
    " 81 82 84 86 90 91 92 93 94 95 98".split()
)
# Characters of an IBAN in countries whose texts are expected.
IBAN_LENGTHS = {
    "AT": 20, "BE": 16, "CH": 21, "DE": 22, "DK": 18, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27,
    "IE": 22, "IT": 27, "LU": 20, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "SE": 24,
}


class Feistel:
    """Keyed permutations of 0..size-1, another one for each kind of value and size."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _mix(self, label: bytes, turn: int, half: int, bits: int) -> int:
        data = b"%b|%d|%x" % (label, turn, half)
        if len(data) > 1024:  # read once, however many digests are made of it
            data = hashlib.blake2b(data, key=self.key).digest()
        size = min(64, bits // 8 + 1)
        made = b""
        while len(made) * 8 < bits:
            made += hashlib.blake2b(data + b"|%d" % len(made), key=self.key, digest_size=size).digest()
        return int.from_bytes(made, "big") & ((1 << bits) - 1)

    def permute(self, value: int, size: int, kind: str) -> int:
        if size <= 1:
            return value
        half = max(1, ((size - 1).bit_length() + 1) // 2)
        label = f"{kind}|{size:x}".encode()
        while True:
            left, right = value >> half, value & ((1 << half) - 1)
            for turn in range(ROUNDS):
                left, right = right, left ^ self._mix(label, turn, right, half)
            value = (left << half) | right
            # Fewer than four values in a row lie outside on average: the domain is under four sizes.
            if value < size:
                return value


def luhn_digit(digits: str) -> str:
    """The check digit that makes ``digits`` a valid card number."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 - i % 2)
        total += d - 9 * (d > 9)
    return str(-total % 10)


def _filled(pattern: str, digits: str) -> str:
    """``pattern`` with its digits replaced in order."""
    new = iter(digits)
    return "".join(next(new) if c in "0123456789" else c for c in pattern)


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _card(text: str, move) -> str | None:
    digits = _digits(text)
    if luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    new = f"{move(int(digits[:-1]), 10 ** (len(digits) - 1)):0{len(digits) - 1}d}"
    return _filled(text, new + luhn_digit(new))


def _iban_check(country: str, rest: str) -> int:
    return 98 - int("".join(str(int(c, 36)) for c in rest + country + "00")) % 97


def _iban(text: str, move) -> str | None:
    plain = text.replace(" ", "")
    country, check, rest = plain[:2], plain[2:4], plain[4:]
    if not 15 <= len(plain) <= 34 or int(check) != _iban_check(country, rest):
        return None
    digits = _digits(rest)
    new = _filled(rest, f"{move(int(digits), 10 ** len(digits)):0{len(digits)}d}") if digits else rest
    marks = iter(f"{country}{_iban_check(country, new):02d}{new}")
    return "".join(c if c == " " else next(marks) for c in text)


def _iban_ends(text: str) -> list[int]:
    """Where an IBAN that begins ``text`` may end, as the form may take in following words: at the
    country's length first, then the longest first."""
    ends = [len(text), *(i for i in range(len(text) - 1, 0, -1) if text[i] == " ")]
    usual = IBAN_LENGTHS.get(text[:2])
    return sorted(ends, key=lambda end: len(text[:end].replace(" ", "")) != usual)


def _ssn(text: str, move) -> str | None:
    area, group, serial = map(int, text.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    areas = 898
    place = area - 1 - (area > 666)
    at = move((place * 99 + group - 1) * 9999 + serial - 1, areas * 99 * 9999)
    place, at = divmod(at, 99 * 9999)
    return f"{place + 1 + (place >= 665):03d}-{at // 9999 + 1:02d}-{at % 9999 + 1:04d}"


def _country_code(digits: str) -> int:
    """How many digits of an international number are its country's."""
    return 1 if digits[0] in "17" else 2 if digits[:2] in TWO_DIGIT_COUNTRIES else 3


def _phone(text: str, move) -> str | None:
    """The country's code stays, and an optional "(0)" after it; all other digits are moved as one
    number, so spellings with other separators stay linked."""
    head, digits = "", _digits(text)
    if not 7 <= len(digits) <= 15:
        return None
    if text[0] == "+":
        places = [m.end() for m in DIGIT.finditer(text)]
        head = text[: places[_country_code(digits) - 1]]
        if optional := OPTIONAL_ZERO.match(text, len(head)):
            head = text[: optional.end()]
    digits = _digits(text[len(head) :])
    if len(digits) < 5:
        return None
    return head + _filled(text[len(head) :], f"{move(int(digits), 10 ** len(digits)):0{len(digits)}d}")


def _ip(text: str, move) -> str | None:
    parts = [int(p) for p in text.split(".")]
    if max(parts) > 255 or any(len(p) > 1 and p[0] == "0" for p in text.split(".")):
        return None
    # Each octet keeps its number of digits, so the text keeps its length.
    spans = [(0, 10) if p < 10 else (10, 90) if p < 100 else (100, 156) for p in parts]
    value, size = 0, 1
    for p, (least, n) in zip(parts, spans):
        value, size = value * n + p - least, size * n
    value, made = move(value, size), []
    for least, n in reversed(spans):
        value, rest = divmod(value, n)
        made.append(str(least + rest))
    return ".".join(reversed(made))


def _moved_date(date: datetime.date, move) -> datetime.date:
    """The pseudonym of a day, whatever form it is written in, so all its spellings stay linked.

    It is a day of the same two centuries (1900 to 2099, 2100 to 2299, ...). Every spelling must be able
    to hold it: months and days of one digit and of two are moved among themselves, so no text changes its
    length, and days that can be no month too, so no text changes its order.
    """
    first = (date.year - 100) // 200 * 200 + 100
    years = range(max(1, first), min(9999, first + 199) + 1)
    months = range(1, 10) if date.month < 10 else range(10, 13)
    days = range(1, 10) if date.day < 10 else range(10, 13) if date.day < 13 else range(13, 32)
    size, form = len(years) * len(months) * len(days), f"{months.start}|{days.start}"
    at = (years.index(date.year) * len(months) + months.index(date.month)) * len(days)
    at += days.index(date.day)
    while True:  # walks on the cycle past the 31st of shorter months
        at = move(at, size, form)
        year_month, day = divmod(at, len(days))
        year, month = divmod(year_month, len(months))
        try:
            return datetime.date(years[year], months[month], days[day])
        except ValueError:
            continue


def _date(text: str, move) -> str | None:
    sep = re.search(r"[-/.]", text).group()
    parts = text.split(sep)
    year_first = len(parts[0]) == 4
    day_first = sep == "." or (not year_first and sep == "-")
    year, month, day = (
        parts if year_first else (parts[2], parts[1], parts[0]) if day_first else (parts[2], *parts[:2])
    )
    try:
        date = datetime.date(int(year), int(month), int(day))
    except ValueError:
        if year_first:
            return None
        day_first, day, month = not day_first, month, day
        try:
            date = datetime.date(int(year), int(month), int(day))
        except ValueError:
            return None
    new = _moved_date(date, move)
    shown = {
        "y": f"{new.year:04d}",
        "m": f"{new.month:0{len(month)}d}",
        "d": f"{new.day:0{len(day)}d}",
    }
    order = "ymd" if year_first else "dmy" if day_first else "mdy"
    return sep.join(shown[c] for c in order)


def _secret(text: str, move) -> str | None:
    if text.isdigit() or not _digits(text):
        return None
    new = f"{move(int(text, 16), 16 ** len(text)):0{len(text)}x}"
    return new.upper() if text.upper() == text else new


def _email_local(text: str, move) -> str:
    """Letters become letters and digits digits; other characters stay."""
    alphabets = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
    value, size, used = 0, 1, []
    for c in text:
        letters = next((a for a in alphabets if c in a), None)
        used.append(letters)
        if letters:
            value, size = value * len(letters) + letters.index(c), size * len(letters)
    value, made = move(value, size), []
    for c, letters in zip(reversed(text), reversed(used)):
        if letters:
            value, rest = divmod(value, len(letters))
            c = letters[rest]
        made.append(c)
    return "".join(reversed(made))


MAKERS: dict[str, Callable] = {
    "card": _card,
    "iban": _iban,
    "ssn": _ssn,
    "phone": _phone,
    "ip": _ip,
    "date": _date,
    "secret": _secret,
}


class Pseudonymiser:
    def __init__(self, key: bytes):
        self.feistel = Feistel(key)

    def _move(self, kind: str):
        return lambda value, size, more="": self.feistel.permute(value, size, f"{kind}{more}")

    def found(self, text: str) -> list[tuple[int, int, str, str]]:
        """(begin, end, kind, pseudonym) of every validated value, in the order of the text."""
        spans: list[tuple[int, int, str, str]] = []
        taken = bytearray()

        def note(begin: int, end: int, kind: str, new: str | None) -> None:
            if new is None or any(taken[begin:end]):
                return
            if not taken:
                taken.extend(bytes(len(text)))
            taken[begin:end] = b"\1" * (end - begin)
            spans.append((begin, end, kind, new))

        if "@" in text:
            for m in EMAIL.finditer(text):
                host, whole = m["host"].lower(), m["local"]
                local = "".join(
                    _email_local(whole[i : i + LOCAL_PART], self._move(f"email|{host}|{i}" if i else f"email|{host}"))
                    for i in range(0, len(whole), LOCAL_PART)
                )
                note(*m.span(), "email", f"{local}@{m['host']}")
        if DIGIT.search(text):
            for kind, form in FORMS.items():
                if kind == "iban":
                    self._note_ibans(text, note)
                    continue
                for m in form.finditer(text):
                    note(*m.span(), kind, MAKERS[kind](m.group(), self._move(kind)))
        return sorted(spans)

    def _note_ibans(self, text: str, note: Callable) -> None:
        at, move = 0, self._move("iban")
        while m := FORMS["iban"].search(text, at):
            # Where nothing fits, the next one may begin inside what the form took in.
            at = m.start() + 1
            for size in _iban_ends(m.group()):
                if (new := _iban(m.group()[:size], move)) is not None:
                    at = m.start() + size
                    note(m.start(), at, "iban", new)
                    break

    def replace(self, text: str) -> tuple[str, dict[str, int]]:
        """The text with its validated values replaced, and how many of each kind."""
        counts: dict[str, int] = {}
        made, at = [], 0
        for begin, end, kind, new in self.found(text):
            counts[kind] = counts.get(kind, 0) + 1
            made += [text[at:begin], new]
            at = end
        return ("".join([*made, text[at:]]) if made else text), counts


def pseudonymised(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """``docs`` with the values in ``text`` replaced; the number of rows and all other columns, whatever
    their names, stay. Null stays null, and a text without such values is unchanged."""
    maker = Pseudonymiser(key)
    at = docs.columns.index(text)

    def run(batches):
        for piece in pieces(batches, text):
            new = [t if t is None else maker.replace(t)[0] for t in piece.column(at).to_pylist()]
            yield piece.set_column(at, piece.schema.field(at), pa.array(new, piece.schema.field(at).type))

    return bounded_batches(docs).mapInArrow(run, docs.schema)


def pseudonym_report(docs: DataFrame, key: bytes, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, n_replaced, n_<kind> for each of ``KINDS``) of every row. A null text stays null
    and has no values; repeated rows are each returned; an empty table gives no rows."""
    maker = Pseudonymiser(key)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    names = ["n_replaced", *(f"n_{k}" for k in KINDS)]
    schema = "doc_id long, text string, " + ", ".join(f"{n} long" for n in names)

    def run(batches):
        for piece in pieces(batches):
            done = [(t, {}) if t is None else maker.replace(t) for t in piece.column(1).to_pylist()]
            counts = [[sum(c.values()), *(c.get(k, 0) for k in KINDS)] for _, c in done]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column(0),
                    pa.array([t for t, _ in done], pa.string()),
                    *(pa.array([c[i] for c in counts], pa.int64()) for i in range(len(names))),
                ],
                names=["doc_id", "text", *names],
            )

    return bounded_batches(rows).mapInArrow(run, schema)
