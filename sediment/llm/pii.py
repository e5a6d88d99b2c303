"""Personal data replaced by keyed pseudonyms of the same format."""

from __future__ import annotations

import datetime
import hashlib
import hmac
import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sediment.llm.common import map_frames


class Permutation:
    """A keyed permutation of the integers below ``size`` for any size: a Feistel network over two
    halves of nearly equal range, walked until the value falls within."""

    ROUNDS = 8

    def __init__(self, key: bytes, size: int, purpose: str):
        self.size = size
        self.low = max(1, math.isqrt(size - 1) + 1) if size > 1 else 1
        self.high = -(-size // self.low)
        self.bytes = max(16, (size.bit_length() + 7) // 8 + 8)
        self.state = hmac.new(key, f"{purpose}:{size}".encode(), hashlib.sha512)

    def _round(self, i: int, value: int) -> int:
        mac = self.state.copy()
        mac.update(f"{i}:{value}".encode())
        data = mac.digest()
        while len(data) < self.bytes:
            data += hashlib.sha512(data).digest()
        return int.from_bytes(data, "big")

    def _once(self, value: int) -> int:
        left, right = divmod(value, self.low)
        for i in range(0, self.ROUNDS, 2):
            left = (left + self._round(i, right)) % self.high
            right = (right + self._round(i + 1, left)) % self.low
        return left * self.low + right

    def _back(self, value: int) -> int:
        left, right = divmod(value, self.low)
        for i in range(self.ROUNDS - 2, -1, -2):
            right = (right - self._round(i + 1, left)) % self.low
            left = (left - self._round(i, right)) % self.high
        return left * self.low + right

    def __call__(self, value: int) -> int:
        value = self._once(value)
        while value >= self.size:
            value = self._once(value)
        return value

    def inverse(self, value: int) -> int:
        value = self._back(value)
        while value >= self.size:
            value = self._back(value)
        return value


def luhn_digit(digits: str) -> int:
    """The check digit that makes ``digits`` followed by it valid."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def _iban_number(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text))


# What the formats look like. Every pattern starts at a rare character, and repeats are bounded.
PATTERNS = {
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "card": re.compile(r"(?<![0-9A-Za-z])[1-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])"),
    "phone": re.compile(
        r"(?<![0-9A-Za-z+])(?:\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}|\+[2-9][0-9]{0,2}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}|(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4})(?![0-9A-Za-z]|\.[0-9])"
    ),
    "ssn": re.compile(r"(?<![0-9A-Za-z-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9A-Za-z]|-[0-9])"),
    "ip": re.compile(r"(?<![0-9A-Za-z.])([0-9]{1,3})\.([0-9]{1,3})\.([0-9]{1,3})\.([0-9]{1,3})(?![0-9A-Za-z]|\.[0-9])"),
    "date": re.compile(
        r"(?<![0-9A-Za-z./-])(?:([0-9]{4})([./-])([0-9]{1,2})\2([0-9]{1,2})(?:(?=[Tt][0-9])|(?![A-Za-z]))|([0-9]{1,2})([./-])([0-9]{1,2})\6([0-9]{4})(?![A-Za-z]))(?![0-9]|[./-][0-9])"
    ),
    "email": re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}"),
}
KINDS = tuple(PATTERNS)
# Cards in one of the usual layouts go before digits that only run on across other numbers.
CARD_LAYOUT = re.compile(
    r"(?<![0-9A-Za-z])[1-9](?:[0-9]{12,18}|[0-9]{3}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,4}(?:\1[0-9]{1,3})?|[0-9]{3}([ -])[0-9]{6}\2[0-9]{4,5})(?![0-9A-Za-z])"
)
# Kinds whose values vary in length, with what may not follow them.
# Digits with one blank or dash between them at most, as far as they go.
DIGIT_RUN, DIGIT, ALNUM = re.compile(r"[0-9](?:[ -]?[0-9])*"), re.compile("[0-9]"), re.compile("[0-9A-Za-z]")
ENDS = {"iban": re.compile(r"(?![A-Za-z0-9])"), "card": re.compile(r"(?![0-9A-Za-z])"), "phone": re.compile(r"(?![0-9A-Za-z]|\.[0-9])")}
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


class Pseudonyms:
    """Replaces validated values. Equal values, however spaced, get equal pseudonyms under one key."""

    def __init__(self, key: bytes):
        self.key, self.made, self.seen = key, {}, {}

    def permute(self, size: int, purpose: str, value: int) -> int:
        if (size, purpose) not in self.made:
            if len(self.made) > 10_000:
                self.made = {}
            self.made[size, purpose] = Permutation(self.key, size, purpose)
        return self.made[size, purpose](value)

    @staticmethod
    def _spread(text: str, digits: str) -> str:
        """``text`` with its digits exchanged in order."""
        at = iter(digits)
        return "".join(next(at) if c.isdigit() else c for c in text)

    def _by_class(self, text: str, purpose: str) -> str:
        """A permutation among the texts with the same letters' cases, digits and other characters."""
        sizes = [(26, 97) if "a" <= c <= "z" else (26, 65) if "A" <= c <= "Z" else (10, 48) if "0" <= c <= "9" else None for c in text]
        value, size = 0, 1
        for c, kind in zip(text, sizes):
            if kind:
                value, size = value * kind[0] + ord(c) - kind[1], size * kind[0]
        shape = "".join(chr(k[1]) if k else c for c, k in zip(text, sizes))
        value = self.permute(size, f"{purpose}:{shape}", value)
        out = []
        for c, kind in zip(reversed(text), reversed(sizes)):
            if kind:
                value, rest = divmod(value, kind[0])
                out.append(chr(kind[1] + rest))
            else:
                out.append(c)
        return "".join(reversed(out))

    def card(self, m: re.Match) -> str | None:
        return self.card_of(m.group())

    def card_of(self, text: str) -> str | None:
        digits = re.sub("[^0-9]", "", text)
        if luhn_digit(digits[:-1]) != int(digits[-1]):
            return None
        least = 10 ** (len(digits) - 2)
        body = str(least + self.permute(9 * least, "card", int(digits[:-1]) - least))
        return self._spread(text, body + str(luhn_digit(body)))

    def iban(self, m: re.Match) -> str | None:
        text = m.group()
        plain = text.replace(" ", "")
        if not 15 <= len(plain) <= 34 or _iban_number(plain[4:] + plain[:4]) % 97 != 1:
            return None
        body = self._by_class(plain[4:], "iban:" + plain[:2])
        check = 98 - _iban_number(body + plain[:2] + "00") % 97
        at = iter(f"{plain[:2]}{check:02d}{body}")
        return "".join(c if c == " " else next(at) for c in text)

    def phone(self, m: re.Match) -> str | None:
        text = m.group()
        lead = re.match(r"\+[0-9]{1,3}(?=[^0-9])", text)
        code = lead.group() if lead else "+" if text.startswith("+") else ""
        digits = re.sub("[^0-9]", "", text[len(code) :])
        whole = re.sub("[^0-9]", "", text)
        if not 8 <= len(whole) <= 15 or not digits:
            return None
        # Without its country code a number is known as that of code 1.
        national = self.permute(10 ** len(digits), f"phone:{code or '+1'}", int(digits))
        return code + self._spread(text[len(code) :], f"{national:0{len(digits)}d}")

    def ssn(self, m: re.Match) -> str | None:
        area, group, serial = map(int, m.groups())
        if not 1 <= area <= 899 or area == 666 or not group or not serial:
            return None
        rank = area - 1 - (area > 666)
        value = self.permute(898 * 99 * 9999, "ssn", (rank * 99 + group - 1) * 9999 + serial - 1)
        value, serial = divmod(value, 9999)
        rank, group = divmod(value, 99)
        area = rank + 1 + (rank >= 665)
        return f"{area:03d}-{group + 1:02d}-{serial + 1:04d}"

    def ip(self, m: re.Match) -> str | None:
        parts = [int(p) for p in m.groups()]
        if max(parts) > 255 or any(p != str(int(p)) for p in m.groups()):
            return None
        value = self.permute(2**32, "ip", int.from_bytes(bytes(parts), "big"))
        return ".".join(str(b) for b in value.to_bytes(4, "big"))

    def date(self, m: re.Match) -> str | None:
        iso = m.group(1) is not None
        year, sep, a, b = (m.group(1), m.group(2), m.group(3), m.group(4)) if iso else (m.group(8), m.group(6), m.group(5), m.group(7))
        day_first = not iso and (int(b) <= 12 and (int(a) > 12 or sep != "/"))
        month, day = (b, a) if day_first else (a, b)
        try:
            known = datetime.date(int(year), int(month), int(day)).toordinal()
        except ValueError:
            return None
        if not FIRST_DAY <= known <= LAST_DAY:
            return None
        new = datetime.date.fromordinal(FIRST_DAY + self.permute(LAST_DAY - FIRST_DAY + 1, "date", known - FIRST_DAY))
        wide = len(a) == 2 and len(b) == 2
        month, day = (f"{new.month:02d}", f"{new.day:02d}") if wide else (str(new.month), str(new.day))
        first, second = (day, month) if day_first else (month, day)
        return sep.join((str(new.year), first, second) if iso else (first, second, str(new.year)))

    def email(self, m: re.Match) -> str | None:
        local, _, domain = m.group().partition("@")
        return f"{self._by_class(local, 'email')}@{domain}"

    @staticmethod
    def _readings(kind: str, pattern: re.Pattern, m: re.Match) -> Iterator[tuple[int, int, re.Match]]:
        """A match, then the shorter ones at its start: the longest may have taken in words or digits behind the value."""
        yield m.start(), m.end(), m
        if kind in ENDS:
            for end in range(m.end() - 1, m.start(), -1):
                if ENDS[kind].match(m.string, end) and (shorter := pattern.fullmatch(m.string, m.start(), end)):
                    yield m.start(), end, shorter

    def _cards(self, text: str, taken: bytearray, found: list) -> None:
        """Cards of any layout, by what ``PATTERNS["card"]`` matches, longest first at each place. Luhn sums of all stretches
        come from two running sums over a run of digits, so tables of numbers cost a few steps a digit."""
        for run in DIGIT_RUN.finditer(text):
            at = [m.start() for m in DIGIT.finditer(text, run.start(), run.end())]
            if len(at) < 13:
                continue
            digits = [ord(text[i]) - 48 for i in at]
            twice = [d * 2 - 9 * (d > 4) for d in digits]
            # By the parity of a number's last place: whose digits are doubled.
            sums = [list(accumulate((t if (i - p) % 2 else d for i, (d, t) in enumerate(zip(digits, twice))), initial=0)) for p in (0, 1)]
            free = [i == 0 or not ALNUM.match(text, i - 1) for i in at]
            ends = [not ALNUM.match(text, i + 1) for i in at]
            first = 0
            while first <= len(at) - 13:
                step = 1
                if digits[first] and free[first]:
                    for last in range(min(first + 18, len(at) - 1), first + 11, -1):
                        total = sums[last % 2]
                        if ends[last] and (total[last + 1] - total[first]) % 10 == 0:
                            start, end = at[first], at[last] + 1
                            if not any(taken[start:end]):
                                taken[start:end] = b"\1" * (end - start)
                                found.append((start, end, "card", self.card_of(text[start:end])))
                                step = last + 1 - first
                                break
                first += step

    def spans(self, text: str) -> list[tuple[int, int, str, str]]:
        """(start, end, kind, pseudonym), ascending, without overlap; earlier kinds go first.

        Where nothing at a place is valid the search goes on one character behind its start."""
        found: list[tuple[int, int, str, str]] = []
        taken = bytearray(len(text))
        for kind, pattern in (("iban", PATTERNS["iban"]), ("card", CARD_LAYOUT), *list(PATTERNS.items())[1:]):
            if kind == "email" and "@" not in text:
                continue
            if pattern is PATTERNS["card"]:
                self._cards(text, taken, found)
                continue
            m = pattern.search(text)
            while m:
                at = m.start() + 1
                for start, end, reading in self._readings(kind, pattern, m):
                    value = None if any(taken[start:end]) else getattr(self, kind)(reading)
                    if value is not None:
                        taken[start:end] = b"\1" * (end - start)
                        found.append((start, end, kind, value))
                        at = end
                        break
                m = pattern.search(text, at)
        return sorted(found)


@dataclass(frozen=True)
class PiiKey:
    """Hex key of the permutations. Keep one per corpus, and keep it secret: with it every pseudonym can be turned back."""

    secret: str

    def __post_init__(self):
        if len(bytes.fromhex(self.secret)) < 16:
            raise ValueError("a key needs 16 bytes or more")


_ANY = re.compile(r"[0-9]|@")


def pseudonymise(df: DataFrame, key: PiiKey, text: str = "text") -> DataFrame:
    """All rows and columns with personal data in the text replaced, ``n_<kind>`` for each kind and
    ``spans`` (kind:start:end in the original, code points, end exclusive, by start); columns of
    these names are replaced.

    Payment cards pass Luhn's check before and after, IBANs the check modulo 97; social security
    numbers, addresses and dates are valid before and after; telephone numbers keep country code and
    punctuation; e-mail addresses keep their domain. Values that fail validation stay as they are. A NULL
    text stays NULL; equal values get equal pseudonyms in every row; an empty table gives no rows."""
    names = [f"n_{kind}" for kind in KINDS] + ["spans"]
    df = df.drop(*[c for c in df.columns if c.lower() in names])
    added = [T.StructField(name, T.StringType() if name == "spans" else T.LongType()) for name in names]
    schema = T.StructType([*df.schema.fields, *added])
    secret = bytes.fromhex(key.secret)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names_of = Pseudonyms(secret)
        for frame in batches:
            texts, counts, spans = [], {kind: [] for kind in KINDS}, []
            for value in frame[text]:
                found = names_of.spans(value) if value and _ANY.search(value) else []
                if found:
                    parts, at = [], 0
                    for start, end, _, new in found:
                        parts += (value[at:start], new)
                        at = end
                    value = "".join([*parts, value[at:]])
                texts.append(value)
                spans.append(",".join(f"{kind}:{start}:{end}" for start, end, kind, _ in found))
                for kind in KINDS:
                    counts[kind].append(sum(k == kind for _, _, k, _ in found))
            yield frame.assign(**{text: texts}, **{f"n_{k}": v for k, v in counts.items()}, spans=spans)

    return map_frames(df, run, schema)


def reverse(key: PiiKey, size: int, purpose: str) -> Callable[[int], int]:
    """The inverse of one permutation, for those who hold the key."""
    return Permutation(bytes.fromhex(key.secret), size, purpose).inverse
