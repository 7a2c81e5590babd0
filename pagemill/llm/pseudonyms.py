"""Format-preserving pseudonyms for personal numbers and dates.

A value is found by its form, validated (Luhn, mod 97, octet and number ranges, the calendar),
turned into a number of its format's domain and permuted there by a keyed Feistel network with
cycle walking, then written in the same form with its check digits made anew.  The permutation
depends on nothing but key, kind and what the form must keep, so equal values get equal pseudonyms
in every document and in every form (a date in any order, a number with or without its country
code, spaces, dashes or capitals), and different values different ones.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import re
from bisect import bisect
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import numbered, read_table, without

ROUNDS = 10


@dataclass(frozen=True)
class Feistel:
    """Keyed permutation of range(size)."""

    key: bytes
    tweak: str
    size: int

    def _halves(self) -> tuple[int, int]:
        a = math.isqrt(max(0, self.size - 1)) + 1
        return a, -(-self.size // a)

    def _round(self, i: int, value: int) -> int:
        number = lambda x: x.to_bytes(x.bit_length() // 8 + 1, "big")
        fields = (self.tweak.encode(), number(self.size), number(i), number(value))
        message = b"".join(len(f).to_bytes(4, "big") + f for f in fields)
        return int.from_bytes(hashlib.blake2b(message, key=self.key[:64], digest_size=32).digest(), "big")

    def _once(self, x: int, back: bool) -> int:
        a, b = self._halves()
        left, right = divmod(x, b)
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if i % 2:
                right = (right + sign * self._round(i, left)) % b
            else:
                left = (left + sign * self._round(i, right)) % a
        return left * b + right

    def permute(self, x: int, back: bool = False) -> int:
        """Walks the cycle of the larger product domain until it is back inside."""
        if not 0 <= x < self.size:
            raise ValueError(f"{x} is not in the domain")
        while True:
            x = self._once(x, back)
            if x < self.size:
                return x


def luhn_digit(digits: str) -> str:
    """The check digit that makes ``digits`` and it a valid number."""
    total = sum(sum(divmod(2 * int(d), 10)) if i % 2 == 0 else int(d) for i, d in enumerate(reversed(digits)))
    return str(-total % 10)


def _refill(form: str, digits: str) -> str:
    """``form`` with its digits replaced in order."""
    it = iter(digits)
    return "".join(next(it) if c in "0123456789" else c for c in form)


def _digits(form: str) -> str:
    return re.sub("[^0-9]", "", form)


Coder = Callable[[str, bytes, bool], str | None]


def _numbers(kind: str, valid: Callable[[str], bool], fixed: int = 0) -> Coder:
    """Permutes the digits after the first ``fixed`` among values for which ``valid`` holds."""

    def code(form: str, key: bytes, back: bool) -> str | None:
        digits = _digits(form)
        if not valid(digits):
            return None
        head, body = digits[:fixed], digits[fixed:]
        feistel = Feistel(key, f"{kind}/{head}", 10 ** len(body))
        while True:
            body = str(feistel.permute(int(body), back)).zfill(len(body))
            if valid(head + body):
                return _refill(form, head + body)

    return code


def _card(form: str, key: bytes, back: bool) -> str | None:
    digits = _digits(form)
    if luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    feistel, body = Feistel(key, "card", 10 ** (len(digits) - 1)), digits[:-1]
    while True:
        body = str(feistel.permute(int(body), back)).zfill(len(body))
        if len(set(whole := body + luhn_digit(body))) > 1:
            return _refill(form, whole)


def _iban(form: str, key: bytes, back: bool) -> str | None:
    plain = form.replace(" ", "")
    as_number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(plain) <= 34 or as_number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    country, body = plain[:2], plain[4:]
    digits = _digits(body)
    body = _refill(body, str(Feistel(key, f"iban/{country}", 10 ** len(digits)).permute(int(digits), back)).zfill(len(digits))) if digits else body
    check = f"{98 - as_number(body + country + '00') % 97:02d}"
    it = iter(country + check + body)
    return "".join(" " if c == " " else next(it) for c in form)


def _ip(form: str, key: bytes, back: bool) -> str | None:
    octets = form.split(".")
    if any(int(o) > 255 or str(int(o)) != o for o in octets):
        return None
    value = Feistel(key, "ip", 1 << 32).permute(int.from_bytes(bytes(map(int, octets)), "big"), back)
    return ".".join(map(str, value.to_bytes(4, "big")))


_YEARS = range(1800, 2200)
#: A pseudonym stays in its date's class, so that it fits every form of the date and reads in the same order.
_DAY_CLASSES, _MONTH_CLASSES = (range(1, 10), range(10, 13), range(13, 32)), (range(1, 10), range(10, 13))


def _moved_date(year: int, month: int, day: int, key: bytes, back: bool) -> tuple[int, int, int]:
    """Another date of the same class: month and day keep their number of digits, days above 12 stay above."""
    months, days = (next(c for c in classes if x in c) for classes, x in ((_MONTH_CLASSES, month), (_DAY_CLASSES, day)))
    feistel = Feistel(key, f"date/{months[0]}/{days[0]}", len(_YEARS) * len(months) * len(days))
    at = ((year - _YEARS[0]) * len(months) + month - months[0]) * len(days) + day - days[0]
    while True:
        at = feistel.permute(at, back)
        rest, d = divmod(at, len(days))
        y, m = divmod(rest, len(months))
        try:
            datetime.date(_YEARS[y], months[m], days[d])
        except ValueError:  # no such day in that month
            continue
        return _YEARS[y], months[m], days[d]


def _date(form: str, key: bytes, back: bool) -> str | None:
    """Years 1800 to 2199.  Year first, or day first; month first only where day first is no date."""
    fields = [int(x) for x in re.findall("[0-9]+", form)]
    year_first = form[:4].isdigit()
    for order in ("ymd",) if year_first else ("dmy", "mdy"):
        parts = dict(zip(order, fields, strict=True))
        try:
            datetime.date(parts["y"], parts["m"], parts["d"])
        except ValueError:
            continue
        if parts["y"] not in _YEARS:
            return None
        new = dict(zip("ymd", _moved_date(parts["y"], parts["m"], parts["d"], key, back), strict=True))
        it = iter(order)
        return re.sub("[0-9]+", lambda m: str(new[next(it)]).zfill(len(m[0])), form)
    return None


# fixed values: country calling codes of one and two digits; all others have three
_SHORT_CODES = (
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
    "81 82 84 86 90 91 92 93 94 95 98"
).split()


def _phone(form: str, key: bytes, back: bool) -> str | None:
    """The part after the country code moves; a number without one counts as one of country code 1."""
    digits = _digits(form)
    if not 8 <= len(digits) <= 15:
        return None
    code = next((digits[:n] for n in (1, 2) if digits[:n] in _SHORT_CODES), digits[:3]) if form[0] == "+" else ""
    body = digits[len(code) :]
    if len(body) < 4:
        return None
    moved = Feistel(key, f"phone/{code or 1}", 10 ** len(body)).permute(int(body), back)
    return _refill(form, code + str(moved).zfill(len(body)))


_LETTERS, _BLOCK = "abcdefghijklmnopqrstuvwxyz", 32


def _email(form: str, key: bytes, back: bool) -> str | None:
    """Letters and digits of the local part move within their class, capitals stay in place; the domain stays.

    Characters move in blocks of 32, each under the plain blocks before it.
    """
    local, _, domain = form.rpartition("@")
    out = list(local)
    for name, alphabet in (("letter", _LETTERS), ("digit", "0123456789")):
        places = [i for i, c in enumerate(local) if c.lower() in alphabet]
        before = hashlib.blake2b(f"{name}/{len(places)}/{domain.lower()}".encode(), digest_size=16)
        for a in range(0, len(places), _BLOCK):
            block = places[a : a + _BLOCK]
            old = [alphabet.index(local[i].lower()) for i in block]
            value = 0
            for x in old:
                value = value * len(alphabet) + x
            value = Feistel(key, f"email/{before.hexdigest()}", len(alphabet) ** len(block)).permute(value, back)
            new = []
            for _ in block:
                value, x = divmod(value, len(alphabet))
                new.append(x)
            new.reverse()
            before.update(bytes(new if back else old))
            for i, x in zip(block, new, strict=True):
                out[i] = alphabet[x].upper() if local[i].isupper() else alphabet[x]
    return f"{''.join(out)}@{domain}"


def _valid_ssn(d: str) -> bool:
    return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"


_NO_WORD_BEFORE, _NO_WORD_AFTER = r"(?<![\w.-])", r"(?![\w-]|\.\d)"
#: kind -> (form, coder); earlier kinds take a place before later ones
KINDS: dict[str, tuple[str, Coder]] = {
    "email": (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}", _email),
    "iban": (rf"{_NO_WORD_BEFORE}[A-Z]{{2}}[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{2,7}}(?:\x20?[A-Z0-9]{{1,3}})?{_NO_WORD_AFTER}", _iban),
    "date": (rf"{_NO_WORD_BEFORE}(?:[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{4}}/[0-9]{{2}}/[0-9]{{2}}|[0-9]{{1,2}}([/.-])[0-9]{{1,2}}\1[0-9]{{4}}){_NO_WORD_AFTER}", _date),
    "ip": (rf"{_NO_WORD_BEFORE}[0-9]{{1,3}}(?:\.[0-9]{{1,3}}){{3}}{_NO_WORD_AFTER}", _ip),
    "ssn": (rf"{_NO_WORD_BEFORE}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}{_NO_WORD_AFTER}", _numbers("ssn", _valid_ssn)),
    "phone": (r"(?<![\w.-])(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![\w-])", _phone),
    "intl_phone": (r"(?<![\w.-])\+[0-9]{1,3}(?:[\x20.-]?[0-9]{2,4}){2,5}(?![\w-])", _phone),
    "card": (rf"{_NO_WORD_BEFORE}[0-9](?:[\x20-]?[0-9]){{12,18}}{_NO_WORD_AFTER}", _card),
}
_FORMS = {kind: re.compile(form, re.ASCII) for kind, (form, _) in KINDS.items()}
_ANY = re.compile(r"[0-9@]")


@lru_cache(maxsize=100_000)
def _coded(kind: str, form: str, key: bytes, back: bool) -> str | None:
    return KINDS[kind][1](form, key, back)


def pseudonymise_text(text: str, key: bytes, back: bool = False) -> tuple[str, dict[str, int]]:
    """The text with pseudonyms, and how many values of each kind were replaced."""
    counts: dict[str, int] = {}
    if not _ANY.search(text):
        return text, counts
    taken: list[tuple[int, int, str]] = []  # in order; matches of one kind do not overlap
    for kind, form in _FORMS.items():
        found = []
        for m in form.finditer(text):
            i = bisect(taken, m.start(), key=lambda t: t[0])
            free = (not i or taken[i - 1][1] <= m.start()) and (i == len(taken) or taken[i][0] >= m.end())
            if free and (new := _coded(kind, m[0], key, back)) is not None:
                found.append((m.start(), m.end(), new))
        if found:
            counts[kind] = len(found)
            taken = sorted(taken + found)
    out, at = [], 0
    for a, b, new in taken:
        out += [text[at:a], new]
        at = b
    return "".join([*out, text[at:]]), counts


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """Replace ``text`` and add ``pseudonyms``, a map of kind to count.

    Null texts stay null with an empty map, texts without values are unchanged, equal rows get
    equal results, values may be of any length; a column named ``pseudonyms`` is replaced, others pass through.  Values that fail validation are left alone.
    """
    docs = without(docs, "pseudonyms")
    names = docs.columns
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(None, {}) if (t := x.as_py()) is None else pseudonymise_text(t, key) for x in batch.column(at)]
            arrays = [pa.array([t for t, _ in found], pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array([list(c.items()) for _, c in found], pa.map_(pa.string(), pa.int32()))], [*names, "pseudonyms"])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return numbered(docs).mapInArrow(run, f"{types}, pseudonyms map<string,int>")


#: For the query alone; a real run passes a secret of its own.
DEMO_KEY = b"a key that is no secret"


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with pseudonyms."""
    found = pseudonymise(read_table(spark, sf_dir, "documents").select("doc_id", "text"), DEMO_KEY)
    return found.select("doc_id", "text", *(F.coalesce(F.col("pseudonyms")[k], F.lit(0)).alias(f"n_{k}") for k in KINDS))
