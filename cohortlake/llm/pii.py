"""Format-preserving pseudonyms for personal data.

Values are found by pattern and validated (card checksum, address ranges, real
dates, ...).  A valid value is a number within its format: digits, letters and
days have fixed places and ranges.  A keyed Feistel network permutes that
number, walking on until it is in range again, so a value becomes another valid
value of the same format, one to one, and equal values stay equal in all
documents.  Without the key the permutation can't be undone.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlake.llm.common import ready

#: For tests and demonstrations; pass a secret one in production.
DEMO_KEY = b"demonstration key, not a secret"
ROUNDS = 8
FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()

#: Every alternative starts where a word does not go on, and takes a bounded length (the
#: name of an address as a whole, without going back), so time follows the text's length
#: whatever it holds.  The last one steps over long words.
PATTERN = re.compile(r"""
    (?<!\w)(?:
        (?<![.%+-])(?P<email>[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]{1,63}\.){1,126}[A-Za-z]{2,}+)
      | (?<!\.)(?P<ip>\d{1,3}(?:\.\d{1,3}){3})(?!\w|\.\d)
      | (?P<iban>[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?)(?!\w)
      | (?<![+-])(?P<date>\d{4}-\d{2}-\d{2}(?=T\d{2}:)|(?:\d{4}-\d{2}-\d{2}|\d{1,2}[/.]\d{1,2}[/.]\d{4})(?!\w|[/.-]\d))
      | (?<!-)(?P<ssn>\d{3}-\d{2}-\d{4})(?![\w-])
      | (?<!-)(?P<card>\d(?:[ -]?\d){12,18})(?![\w-])
      | (?P<secret>[0-9a-f]{32,64}|[0-9A-F]{32,64})(?!\w)
    )
  | (?P<phone>\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\w)
      | (?<!\w)\(\d{3}\)[ ]?\d{3}-\d{4}(?!\w) | (?<![\w.+-])\d{3}(?P<between>[.-])\d{3}(?P=between)\d{4}(?![\w-]|\.\d))
  | (?<!\w)\w{65,}+
""", re.X | re.A)
#: Longest name of a mail address.
LONGEST_NAME = 64
# Country calling codes of one and of two digits; all others have three.
CODES_1 = "1 7".split()
CODES_2 = ("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 "
           "60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98").split()
#: The country of numbers written without a code: (ddd) ddd-dddd and ddd-ddd-dddd.
HOME_CODE = "1"
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Feistel:
    """Keyed permutations of range(size) for any size, one for each kind of value."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def permute(self, kind: str, value: int, size: int, back: bool = False) -> int:
        """The image of value, or with ``back`` the value whose image it is."""
        if size < 2:
            return value
        half = max(1, ((size - 1).bit_length() + 1) // 2)
        mask, width = (1 << half) - 1, (half + 7) // 8
        rounds = range(ROUNDS)
        while True:
            a, b = value >> half, value & mask
            for r in reversed(rounds) if back else rounds:
                x = a if back else b
                h = hashlib.blake2b(b"%s/%d/%d/%d" % (kind.encode(), size, r, x), key=self.key, digest_size=min(64, width + 8))
                f = int.from_bytes(h.digest(), "big") & mask
                a, b = (b ^ f, a) if back else (b, a ^ f)
            value = a << half | b
            if value < size:
                return value


def luhn(digits: str) -> int:
    """The check digit that follows the digits."""
    total = sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits))))
    return -total % 10


def _places(feistel: Feistel, kind: str, text: str, fixed: int = 0, alphabets=(DIGITS, LOWER, UPPER), back: bool = False) -> str:
    """Permutes the characters of the alphabets from place ``fixed`` on as one
    number; a leading nonzero digit stays nonzero."""
    slots, value, size, first = [], 0, 1, True
    for i, c in enumerate(text):
        a = next((a for a in alphabets if c in a), None)
        if i < fixed or a is None:
            continue
        if a is DIGITS and first:
            a = "0" if c == "0" else DIGITS[1:]
        first = False
        slots.append((i, a))
        value, size = value * len(a) + a.index(c), size * len(a)
    value, out = feistel.permute(kind + "".join(str(len(a)) + "," for _, a in slots), value, size, back), list(text)
    for i, a in reversed(slots):
        value, k = divmod(value, len(a))
        out[i] = a[k]
    return "".join(out)


def _digits(text: str, new: str) -> str:
    """``text`` with its digits replaced in order."""
    it = iter(new)
    return "".join(next(it) if c in DIGITS else c for c in text)


def calling_code(digits: str) -> str:
    """The country code that the digits of an international number start with."""
    if digits[0] == "0":
        return ""
    return digits[:1] if digits[0] in CODES_1 else digits[:2] if digits[:2] in CODES_2 else digits[:3]


def pseudonym(feistel: Feistel, kind: str, text: str, back: bool = False) -> str | None:
    """The pseudonym of a value, or None where it isn't a valid one of its kind."""
    only = re.sub(r"\D", "", text)
    if kind == "email":
        name, _, host = text.partition("@")
        if len(name) > LONGEST_NAME:
            return None
        return _places(feistel, kind, name, back=back) + "@" + host
    if kind == "ip":
        parts = text.split(".")
        if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
            return None
        n = feistel.permute(kind, int.from_bytes(bytes(map(int, parts)), "big"), 1 << 32, back)
        return ".".join(map(str, n.to_bytes(4, "big")))
    if kind == "date":
        sep = next(c for c in text if c not in DIGITS)
        parts = text.split(sep)
        try:
            order = (0, 1, 2) if sep == "-" else (2, 1, 0) if int(parts[1]) <= 12 and sep != "/" else (2, 0, 1)
            if sep == "/" and int(parts[0]) > 12:
                order = (2, 1, 0)
            day = dt.date(*(int(parts[i]) for i in order)).toordinal()
        except ValueError:
            return None
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        # one permutation of days for all ways to write them; slashed dates are written
        # month first, which is how they are read unless that can't be
        date = dt.date.fromordinal(FIRST_DAY + feistel.permute(kind, day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, back))
        if sep == "/":
            order = (2, 0, 1)
        fields = {order[0]: f"{date.year:04}", order[1]: f"{date.month:02}", order[2]: f"{date.day:02}"}
        return sep.join(fields[i] for i in range(3))
    if kind == "ssn":
        if only[:3] in ("000", "666") or only[0] == "9" or only[3:5] == "00" or only[5:] == "0000":
            return None
        n = ((int(only[:3]) - 1 - (int(only[:3]) > 666)) * 99 + int(only[3:5]) - 1) * 9999 + int(only[5:]) - 1
        n = feistel.permute(kind, n, 898 * 99 * 9999, back)
        n, serial = divmod(n, 9999)
        area, group = divmod(n, 99)
        return f"{area + 1 + (area + 1 >= 666):03}-{group + 1:02}-{serial + 1:04}"
    if kind == "phone":
        if not 7 <= len(only) <= 15:
            return None
        code = calling_code(only) if text[0] == "+" else ""
        national = only[len(code):]
        # by its country and national number, however it is written
        return _digits(text, code + _places(feistel, f"{kind}{code or HOME_CODE}/", national, back=back))
    if kind == "card":
        if luhn(only[:-1]) != int(only[-1]) or len(set(only)) == 1:
            return None
        body = _places(feistel, kind, only[:-1], back=back)
        return _digits(text, body + str(luhn(body)))
    if kind == "iban":
        flat = text.replace(" ", "")
        number = lambda s: int("".join(str(int(c, 36)) for c in s))
        if not 15 <= len(flat) <= 34 or number(flat[4:] + flat[:4]) % 97 != 1:
            return None
        body = _places(feistel, kind, flat[4:], back=back)
        it = iter(flat[:2] + f"{98 - number(body + flat[:2] + '00') % 97:02}" + body)
        return "".join(c if c == " " else next(it) for c in text)
    if len(set(text)) < 8:
        return None
    alphabet = "0123456789abcdef" if text == text.lower() else "0123456789ABCDEF"
    n = feistel.permute(f"{kind}{len(text)}", int(text, 16), 16 ** len(text), back)
    return "".join(alphabet[int(c, 16)] for c in f"{n:0{len(text)}x}")


def replace(feistel: Feistel, text: str, back: bool = False) -> tuple[str, dict[str, int]]:
    """The text with pseudonyms, and how many values of each kind it had."""
    counts: dict[str, int] = {}

    def one(m: re.Match) -> str:
        kind = next((k for k in KINDS if m[k] is not None), None)
        if kind is None:
            return m[0]
        new = pseudonym(feistel, kind, m[kind], back)
        if new is None:
            return m[0]
        counts[kind] = counts.get(kind, 0) + 1
        return m[0].replace(m[kind], new, 1)

    return PATTERN.sub(one, text), counts


KINDS = [k for k in PATTERN.groupindex if k != "between"]
#: What a text needs to have any value: an at sign, a digit, or a long hex run.
HINT = re.compile(r"@|[0-9]")


def pseudonymize(docs: DataFrame, key: bytes = DEMO_KEY, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with pseudonyms in ``text``, and ``pii`` (a map from kind to
    number of values; a column of that name in ``docs`` is left out).

    A null text stays null and an empty one empty, both with an empty map; texts
    without valid values stay as they are; rows that repeat are changed alike;
    no column but ``text`` is read; an empty table gives an empty result.  Time follows
    a text's length, also of a single run of many megabytes.

    Equal values become equal ones however they are written: a day as 2024-02-29,
    29.02.2024, 02/29/2024 or 29/02/2024 (slashed pseudonyms stand month first), a phone
    number with or without its country code and separators, a card or account number
    with or without blanks.  Left as they are: the host of a mail address, national phone
    numbers in other forms than (ddd) ddd-dddd, ddd-ddd-dddd and ddd.ddd.dddd, dates in
    words or of two-digit years, names of over 64 characters before an ``@``."""
    ready(docs.sparkSession)
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != "pii"]).withColumn(text, F.col(text).cast("string"))
    at = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField("pii", T.MapType(T.StringType(), T.IntegerType(), False))])

    def run(batches):
        feistel = Feistel(key)
        for batch in batches:
            texts, maps = [], []
            for value in batch.column(at).to_pylist():
                if value and HINT.search(value):
                    value, counts = replace(feistel, value)
                    maps.append(list(counts.items()))
                else:
                    maps.append([])
                texts.append(value)
            columns = [c if i != at else pa.array(texts, pa.string()) for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(maps, pa.map_(pa.string(), pa.int32()))], [*docs_names, "pii"])

    docs_names = docs.columns
    return docs.mapInArrow(run, schema)
