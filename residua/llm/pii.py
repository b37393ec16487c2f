"""PII: format-preserving Feistel pseudonyms.

Values that validate (card and account numbers by checksum, addresses by range, dates by calendar, phone numbers by length) are
replaced by the value that a keyed permutation of their format's domain assigns. Equal values get equal pseudonyms in all
documents and runs with the same key, different ones stay different, and a pseudonym validates just as the value did.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from residua.llm.common import column, packed, slices, unpacked

KINDS = ("email", "ip", "card", "iban", "phone", "ssn", "date", "secret")
ROUNDS = 8
DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()

#: Where values of each kind may stand; a find is validated before it counts.
SHAPES = {
    "secret": r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])|(?:gh[pousr]_|sk-|xox[abp]-)[0-9A-Za-z-]{16,}|(?=[0-9]*[a-f])(?=[a-f]*[0-9])[0-9a-f]{16,128}(?![0-9A-Za-z])",
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])",
    "ip": r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])",
    "date": r"[0-9]{4}(?:-[0-9]{1,2}-|/[0-9]{1,2}/|\.[0-9]{1,2}\.)[0-9]{1,2}(?![0-9A-Za-z])|[0-9]{1,2}(?:-[0-9]{1,2}-|/[0-9]{1,2}/|\.[0-9]{1,2}\.)[0-9]{4}(?![0-9A-Za-z])",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])",
    "card": r"[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
    "phone": r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,5}\)[ .-]?)?[0-9]{2,15}(?:[ .-][0-9]{2,8}){0,5}(?![0-9A-Za-z])"
    r"|\([0-9]{2,5}\)[ .-]?[0-9]{3,5}[ .-]?[0-9]{3,6}(?![0-9A-Za-z])|[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z]|[.-][0-9])",
}
PATTERN = re.compile(r"(?<![0-9A-Za-z])(?<![0-9]\.)(?:" + "|".join(f"(?P<{k}>{p})" for k, p in SHAPES.items()) + ")")
ALONE = {k: re.compile(p) for k, p in SHAPES.items()}
#: Kinds whose finds may have run on into the number or word behind them, and those of them that have a checksum.
CHECKED = ("iban", "card")
JOINED = (*CHECKED, "phone")
GROUP = re.compile(r"[0-9A-Za-z]+")
EMAIL = re.compile(r"([0-9A-Za-z.!#$%&'*+/=?^_`{|}~-]+)(@[0-9A-Za-z-]+(?:\.[0-9A-Za-z-]+)+)")


@dataclass(frozen=True)
class Pseudonyms:
    """``apply`` replaces the values of every text.

    secret  the key; who has it could undo the permutation
    kinds   which kinds count

    Defined results: a null text stays null with count 0; texts of any length are handled whole; values that do not validate stay as they are;
    of a find that does not validate, the longest run of its groups that does counts, group by group from the first, also beyond the find;
    a permutation may map a value to itself, in which case it is applied until it does not; an empty table gives an empty table.
    """

    secret: str = "residua"
    text: str = "text"
    kinds: tuple[str, ...] = KINDS

    def apply(self, docs: DataFrame) -> DataFrame:
        """All rows and columns, the text replaced, with ``n_replaced`` and ``kinds``, the kinds found, sorted."""
        made = [self.text, "n_replaced", "kinds"]
        base = packed(docs, made, given=column(self.text))
        added = [T.StructField(self.text, T.StringType()), T.StructField("n_replaced", T.LongType()), T.StructField("kinds", T.ArrayType(T.StringType()))]
        secret, wanted = self.secret, frozenset(self.kinds)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keyed = Keyed(secret)
            for batch, texts in slices(batches, "given"):
                made, counts, kinds = [], [], []
                for given, raw in zip(batch.column("given").is_valid().to_pylist(), texts, strict=True):
                    text, found = replace(raw.decode(), keyed, wanted)
                    made.append(text if given else None)
                    counts.append(len(found))
                    kinds.append(sorted(set(found)))
                arrays = [batch.column("row")]
                arrays += [pa.array(made, pa.string()), pa.array(counts, pa.int64()), pa.array(kinds, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["row", *[f.name for f in added]])

        out = unpacked(base.mapInArrow(run, T.StructType([base.schema["row"], *added])), made)
        order = [c for c in docs.columns if c.lower() not in ("n_replaced", "kinds")]
        return out.select(*[column(c) for c in order], "n_replaced", "kinds")


def replace(text: str, keyed: Keyed, wanted: frozenset[str]) -> tuple[str, list[str]]:
    """The text with pseudonyms, and the kinds of the values replaced."""
    found: list[str] = []

    def mail(match: re.Match) -> str:
        found.append("email")
        return keyed.pseudonym("email", match.group(1)) + match.group(2)

    if "email" in wanted and "@" in text:
        text = EMAIL.sub(mail, text)
    out, done, at = [], 0, 0
    while match := PATTERN.search(text, at):
        start, end = match.span()
        value = match.group()
        # a find that does not validate as its own kind may do so as another
        others = (k for k in ALONE if ALONE[k].fullmatch(value))
        tried = ((k, keyed.pseudonym(k, value)) for k in (match.lastgroup, *others) if k in wanted)
        kind, new = next(((k, n) for k, n in tried if n is not None), (None, None))
        bitten = kind == "phone" and bites(text, start, end, keyed)
        if bitten or new is None and keyed.pseudonym(match.lastgroup, value) is None:
            kind, new, end = first_valid(text, start, keyed, wanted)
            if new is None:  # the next number may begin inside this find and end behind it
                at = GROUP.search(text, start).end()
                continue
        if new is not None:
            found.append(kind)
            out += [text[done:start], new]
            done = end
        at = end
    return "".join([*out, text[done:]]), found


def first_valid(text: str, start: int, keyed: Keyed, wanted: Iterable[str]) -> tuple[str | None, str | None, int]:
    """Kind, pseudonym and end of the longest valid run of whole groups from ``start`` on, by kind; kinds with a checksum first."""
    for kind in JOINED:
        match = ALONE[kind].match(text, start) if kind in wanted else None
        if not match:
            continue
        groups = list(GROUP.finditer(text, start, match.end()))
        for k in range(len(groups), 0, -1):
            end = groups[k - 1].end()
            if not ALONE[kind].fullmatch(text, start, end):
                continue
            new = keyed.pseudonym(kind, text[start:end])
            if new is None:
                continue
            if kind in CHECKED or not bites(text, start, end, keyed):
                return kind, new, end
    return None, None, start


def bites(text: str, start: int, end: int, keyed: Keyed) -> bool:
    """Whether a run that only its length speaks for takes the head of a value that begins in a later group and ends behind it."""
    for group in list(GROUP.finditer(text, start, end))[1:]:
        match = PATTERN.match(text, group.start())
        if match and match.end() > end and match.lastgroup != "phone" and keyed.pseudonym(match.lastgroup, match.group()) is not None:
            return True
        if first_valid(text, group.start(), keyed, CHECKED)[2] > end:
            return True
    return False


class Keyed:
    """Pseudonyms under one key, remembered for values that come back."""

    def __init__(self, secret: str):
        self.key = hashlib.blake2b(secret.encode(), digest_size=32).digest()
        self.known: dict[tuple[str, str], str | None] = {}

    def pseudonym(self, kind: str, value: str) -> str | None:
        """The value's pseudonym; None if it does not validate."""
        at = (kind, value)
        if at not in self.known:
            if len(self.known) > 100_000:
                self.known.clear()
            self.known[at] = getattr(self, "_" + kind)(value)
        return self.known[at]

    def permute(self, value: int, size: int, tweak: str, inside=None) -> int:
        """A keyed permutation of 0 .. size - 1, or of the numbers among them that are ``inside``, that leaves no number where it is.

        Feistel, a keyed shift, and Feistel back. The shift shares no factor with ``size``, so all numbers form one cycle: the next number
        inside is another one, unless there is no other.
        """
        if size < 2:
            return value
        shift = 1 + self._noise(ROUNDS, size, tweak) % (size - 1)
        while math.gcd(shift, size) > 1:
            shift = shift % (size - 1) + 1
        while True:
            value = self._feistel((self._feistel(value, size, tweak) + shift) % size, size, tweak, back=True)
            if inside is None or inside(value):
                return value

    def _feistel(self, value: int, size: int, tweak: str, back: bool = False) -> int:
        """A keyed permutation of 0 .. size - 1, or its inverse: a network on a * b >= size numbers, where numbers outside are sent through again."""
        a = math.isqrt(size - 1) + 1
        b = -(-size // a)
        sign = -1 if back else 1
        while True:
            left, right = divmod(value, b)
            for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
                if r % 2:
                    right = (right + sign * self._noise(r, left, tweak)) % b
                else:
                    left = (left + sign * self._noise(r, right, tweak)) % a
            value = left * b + right
            if value < size:
                return value

    def _noise(self, r: int, half: int, tweak: str) -> int:
        message = f"{r}|{tweak}|{half}".encode()
        return int.from_bytes(hashlib.blake2b(message, key=self.key, digest_size=16).digest(), "big")

    def spelled(self, value: str, tweak: str) -> str:
        """Digits to digits, letters to letters of the same case, everything else in place; one permutation of all such strings."""
        sizes = [10 if c in DIGITS else 26 if c.lower() in LOWER else 0 for c in value]
        number, total = 0, 1
        for c, n in zip(value, sizes, strict=True):
            if n:
                number = number * n + (DIGITS if n == 10 else LOWER).index(c.lower())
                total *= n
        if total < 2:
            return value
        number = self.permute(number, total, f"{tweak}|{''.join(map(str, sizes))}")
        out = []
        for c, n in zip(reversed(value), reversed(sizes), strict=True):
            if not n:
                out.append(c)
                continue
            number, k = divmod(number, n)
            new = (DIGITS if n == 10 else LOWER)[k]
            out.append(new.upper() if c.isupper() else new)
        return "".join(reversed(out))

    def _email(self, local: str) -> str:
        return self.spelled(local, "email")

    def _secret(self, value: str) -> str | None:
        if re.fullmatch(r"[0-9a-f]+", value):
            if not (re.search("[0-9]", value) and re.search("[a-f]", value)):
                return None
            size = 16 ** len(value)
            return f"{self.permute(int(value, 16), size, f'hex{len(value)}'):0{len(value)}x}"
        head = re.match(r"AKIA|gh[pousr]_|sk-|xox[abp]-", value).group()
        return head + self.spelled(value[len(head) :], "secret" + head)

    def _ip(self, value: str) -> str | None:
        parts = value.split(".")
        if any(int(p) > 255 or p != str(int(p)) for p in parts):
            return None
        number = int.from_bytes(bytes(map(int, parts)), "big")
        return ".".join(map(str, self.permute(number, 1 << 32, "ip").to_bytes(4, "big")))

    def _card(self, value: str) -> str | None:
        digits = [c for c in value if c in DIGITS]
        if luhn(digits[:-1]) != int(digits[-1]) or len(set(digits)) == 1:
            return None
        body = self._digits("".join(digits[:-1]), "card")
        return laid_out(value, body + str(luhn(list(body))))

    def _digits(self, digits: str, tweak: str) -> str:
        n = len(digits)
        return f"{self.permute(int(digits), 10**n, f'{tweak}{n}'):0{n}d}"

    def _phone(self, value: str) -> str | None:
        digits = "".join(c for c in value if c in DIGITS)
        if not 7 <= len(digits) <= 15 or "+" not in value and "(" not in value and len(digits) < 10:
            return None
        # the country's code stays, so that the number remains one of its kind, however it is spelled
        keep = country_code(digits) if "+" in value else 0
        return laid_out(value, digits[:keep] + self._digits(digits[keep:], "phone" + digits[:keep]))

    def _ssn(self, value: str) -> str | None:
        valid = lambda n: n // 10**6 not in (0, 666) and n // 10**6 < 900 and n // 10**4 % 100 and n % 10**4
        number = int(value.replace("-", ""))
        if not valid(number):
            return None
        return laid_out(value, f"{self.permute(number, 10**9, 'ssn', valid):09d}")

    def _iban(self, value: str) -> str | None:
        plain = value.replace(" ", "")
        if not 15 <= len(plain) <= 34 or check97(plain) != 1:
            return None
        body = self.spelled(plain[4:], "iban" + plain[:2])
        return laid_out(value, plain[:2] + f"{98 - check97(plain[:2] + '00' + body):02d}" + body, " ")

    def _date(self, value: str) -> str | None:
        parts = re.split(r"([-/.])", value)
        year_first = len(parts[0]) == 4
        year, month, day = (parts[0], parts[2], parts[4]) if year_first else (parts[4], parts[2], parts[0])
        month_first = not year_first and parts[1] == "/" and int(month) > 12
        if month_first:  # 12/31/1999
            month, day = day, month
        try:
            number = datetime.date(int(year), int(month), int(day)).toordinal()
        except ValueError:
            return None
        if not FIRST_DAY <= number <= LAST_DAY:
            return None
        # days that can be no month stay among themselves: a pseudonym reads in the same order as its value, however the date is spelled
        clear = int(day) > 12
        size = LAST_DAY - FIRST_DAY + 1
        alike = lambda k: (datetime.date.fromordinal(FIRST_DAY + k).day > 12) == clear
        new = datetime.date.fromordinal(FIRST_DAY + self.permute(number - FIRST_DAY, size, "date", alike))
        y, m, d = f"{new.year:04d}", f"{new.month:02d}", f"{new.day:02d}"
        return parts[1].join([y, m, d] if year_first else [m, d, y] if month_first else [d, m, y])


#: Country codes of one and of two digits; all others have three.
SHORT_CODES = ("1", "7")
TWO_DIGIT_CODES = (
    "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "53", "54", "55", "56", "57", "58",
    "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98",
)


def country_code(digits: str) -> int:
    """Digits of the country's code at the head of an international number."""
    return 1 if digits.startswith(SHORT_CODES) else 2 if digits.startswith(TWO_DIGIT_CODES) else 3


def laid_out(value: str, symbols: str, gaps: str = " -()+./") -> str:
    """New symbols where the value has its own; separators in place."""
    new = iter(symbols)
    return "".join(c if c in gaps else next(new) for c in value)


def luhn(digits: list[str]) -> int:
    """Check digit that follows these digits."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        n = int(c) * (2 - k % 2)
        total += n - 9 * (n > 9)
    return -total % 10


def check97(plain: str) -> int:
    moved = plain[4:] + plain[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97
