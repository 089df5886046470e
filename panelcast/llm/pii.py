"""Format-preserving pseudonyms for personal data.

Finds e-mail addresses, secrets that are assigned to a name, IBANs, IPv4 addresses, payment cards, phone numbers,
social security numbers and dates; numbers and dates count only when they validate (check digits, octets, calendar).
Each value is numbered inside the set of all values of its format and that number goes through a keyed permutation, a
Feistel network of ten rounds with cycle walking, so the pseudonym has the same format and validates as well.

The map is a bijection for each format: equal values have equal pseudonyms in all documents and for all spellings
(separators, case), different values have different ones, and the key inverts it. It has no fixed points: a number is
enciphered, one is added, and the sum is deciphered, which is one cycle through the whole set.

Defined cases: null texts stay null, texts without personal data stay as they are; digits are 0-9; overlapping finds
go to the earlier kind of KINDS; repeated rows and further columns do not matter. Lengths in characters never change.
"""

from __future__ import annotations

import bisect
import datetime as dt
import hashlib
import math
import re
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
#: Key of the registered query; a real run brings its own.
DEMO_KEY = b"corpus pseudonyms"

# Fixed formats of the kinds, in order of precedence.
EMAIL = re.compile(
    r"(?<![A-Za-z0-9._%+-])([A-Za-z0-9_][A-Za-z0-9._%+-]{0,63})@((?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24})(?![A-Za-z0-9])"
)
SECRET = re.compile(
    r"(?i)(?<![a-z0-9])(?:api[_-]?key|access[_-]?key|secret[_-]?key|client[_-]?secret|secret|token|password|passwd|pwd)"
    r"[\"']?\s{0,8}[:=]\s{0,8}[\"']?([a-z0-9+/_-][a-z0-9+/_.=~-]{14,}[a-z0-9+/_=~-])"
)
IBAN = re.compile(r"(?<![A-Za-z0-9])([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Za-z0-9])")
IPV4 = re.compile(r"(?<![0-9A-Za-z.])((?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9]))(?![0-9A-Za-z]|\.[0-9])")
CARD = re.compile(
    r"(?<![0-9A-Za-z])(?<![0-9][.-])([0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\2[0-9]{4}\2[0-9]{1,7}|[0-9]{4}([ -])[0-9]{6}\3[0-9]{5})(?![0-9A-Za-z]|[.-][0-9])"
)
PHONE = re.compile(
    r"(?<![0-9A-Za-z+(])((?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4})"
    r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4})(?![0-9A-Za-z]|[.-][0-9])"
)
SSN = re.compile(r"(?<![0-9A-Za-z-])((?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4})(?![0-9A-Za-z]|-[0-9])")
DATE = re.compile(r"(?<![0-9A-Za-z./-])((?:19|20)[0-9]{2}([-/.])[0-9]{2}\2[0-9]{2}|[0-9]{2}([-/.])[0-9]{2}\3(?:19|20)[0-9]{2})(?![0-9A-Za-z]|[./-][0-9])")
#: Signs that are permuted as one number; longer values go piece by piece.
PIECE = 64
#: First value and number of values of an octet, by its length.
_OCTETS = {1: (0, 10), 2: (10, 90), 3: (100, 156)}
KINDS = ("email", "secret", "iban", "ipv4", "card", "phone", "ssn", "date")

FIRST_DAY, DAYS = dt.date(1900, 1, 1), (dt.date(2100, 1, 1) - dt.date(1900, 1, 1)).days
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn_digit(payload: str) -> str:
    """The digit that makes ``payload`` plus it pass the Luhn check."""
    total = 0
    for place, digit in enumerate(reversed(payload)):
        value = int(digit) * (2 - place % 2)
        total += value - 9 if value > 9 else value
    return str(-total % 10)


def iban_digits(country: str, account: str) -> str:
    number = int("".join(str(int(c, 36)) for c in account + country + "00"))
    return f"{98 - number % 97:02d}"


class Permutation:
    """A keyed bijection of 0 .. size-1 without fixed points (for size > 1)."""

    def __init__(self, key: bytes, tweak: str, size: int):
        self.size = size
        self.a = math.isqrt(size - 1) + 1 if size > 1 else 1
        self.b = -(-size // self.a)
        self._seed = hashlib.blake2b(tweak.encode(), key=key, digest_size=32).digest()

    def _round(self, i: int, half: int) -> int:
        data = i.to_bytes(1, "big") + half.to_bytes((half.bit_length() + 7) // 8 or 1, "big")
        width = min(64, (max(self.a, self.b).bit_length() + 7) // 8 + 16)
        return int.from_bytes(hashlib.blake2b(data, key=self._seed, digest_size=width).digest(), "big")

    def _network(self, x: int, rounds, sign: int) -> int:
        left, right = divmod(x, self.b)
        for i in rounds:
            if i % 2:
                right = (right + sign * self._round(i, left)) % self.b
            else:
                left = (left + sign * self._round(i, right)) % self.a
        return left * self.b + right

    def _walk(self, x: int, rounds, sign: int) -> int:
        x = self._network(x, rounds, sign)
        while x >= self.size:
            x = self._network(x, rounds, sign)
        return x

    def _step(self, x: int, by: int) -> int:
        y = self._walk(x, range(ROUNDS), 1)
        return self._walk((y + by) % self.size, range(ROUNDS - 1, -1, -1), -1)

    def apply(self, x: int) -> int:
        return self._step(x, 1)

    def invert(self, x: int) -> int:
        return self._step(x, -1)


class Pseudonyms:
    """Replaces single values; ``replace`` and ``restore`` are inverse to each other."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()
        self._permutation = lru_cache(4096)(lambda tweak, size: Permutation(self.key, tweak, size))
        self.replace = lru_cache(1 << 16)(lambda kind, value: self._map(kind, value, Permutation.apply))

    def restore(self, kind: str, value: str) -> str:
        return self._map(kind, value, Permutation.invert)

    def _number(self, tweak: str, size: int, x: int, how) -> int:
        return how(self._permutation(tweak, size), x)

    def _text(self, kind: str, value: str, how) -> str:
        """Permute letters and digits, each in its class; case stays where it was, other signs stay."""
        low = value.lower() if value.isascii() else value
        is_hex = kind == "secret" and value in (low, low.upper()) and all(c in "0123456789abcdef" for c in low)
        letters = "abcdefghijklmnopqrstuvwxyz"
        alphabets = [
            ("0123456789abcdef" if is_hex else "0123456789" if "0" <= c <= "9" else letters if "a" <= c <= "z" else "") for c in low
        ]
        out, before = [], ""
        for at in range(0, len(low), PIECE):
            signs, own = low[at : at + PIECE], alphabets[at : at + PIECE]
            size, x = 1, 0
            for c, alphabet in zip(signs, own):
                if alphabet:
                    size, x = size * len(alphabet), x * len(alphabet) + alphabet.index(c)
            tweak = f"{kind}:{before}" + "".join(str(len(a)) + "," if a else c for c, a in zip(signs, own))
            x, new = self._number(tweak, size, x, how), []
            for c, alphabet in zip(reversed(signs), reversed(own)):
                if alphabet:
                    x, place = divmod(x, len(alphabet))
                    c = alphabet[place]
                new.append(c)
            new = "".join(reversed(new))
            out.append(new)
            # what stands before decides how a later piece is permuted
            plain = signs if how is Permutation.apply else new
            before = hashlib.blake2b(f"{before}{plain}".encode(), key=self.key, digest_size=16).hexdigest() + ":"
        upper = value.upper() == value and is_hex
        return "".join(c.upper() if upper or (o.isupper() and not is_hex) else c for c, o in zip("".join(out), value))

    def _digits(self, value: str, digits: str) -> str:
        """``value`` with its digits replaced in order."""
        new = iter(digits)
        return _DIGIT.sub(lambda _: next(new), value)

    def _map(self, kind: str, value: str, how) -> str:
        digits = _NOT_DIGIT.sub("", value)
        if kind == "email":
            local, _, domain = value.partition("@")
            return f"{self._text('email@' + domain.lower(), local, how)}@{domain}"
        if kind == "secret":
            return self._text(kind, value, how)
        if kind == "iban":
            plain = value.replace(" ", "")
            account = self._text("iban" + plain[:2], plain[4:].lower(), how).upper()
            new = iter(plain[:2] + iban_digits(plain[:2], account) + account)
            return "".join(c if c == " " else next(new) for c in value)
        if kind == "ipv4":
            octets = [(int(o), *_OCTETS[len(o)]) for o in value.split(".")]
            size, x = 1, 0
            for octet, low, count in octets:
                size, x = size * count, x * count + octet - low
            x, out = self._number(kind + ",".join(str(c) for _, _, c in octets), size, x, how), []
            for _, low, count in reversed(octets):
                x, place = divmod(x, count)
                out.append(str(place + low))
            return ".".join(reversed(out))
        if kind == "card":
            inner = digits[1:-1]
            new = f"{self._number(f'card{len(digits)}{digits[0]}', 10 ** len(inner), int(inner), how):0{len(inner)}d}"
            return self._digits(value, digits[0] + new + luhn_digit(digits[0] + new))
        if kind == "phone":
            # Without a plus the forms are those of country 1.
            kept = "" if value[0] != "+" else digits[:1] if digits[0] == "1" else digits[:2]
            inner = digits[len(kept) :]
            new = f"{self._number(f'phone{kept or 1}:{len(inner)}', 10 ** len(inner), int(inner), how):0{len(inner)}d}"
            return self._digits(value, kept + new)
        if kind == "ssn":
            area, group, serial = (int(x) for x in value.split("-"))
            x = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
            x, serial = divmod(self._number(kind, 898 * 99 * 9999, x, how), 9999)
            area, group = divmod(x, 99)
            return f"{area + 1 + (area >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"
        day, style = _date(value)
        while True:  # walk on until the new date reads in the same order of day and month
            day = FIRST_DAY + dt.timedelta(self._number(kind, DAYS, (day - FIRST_DAY).days, how))
            if _date(day.strftime(style))[1] == style:
                return day.strftime(style)


def _date(value: str) -> tuple[dt.date, str] | None:
    """The day and its format; day before month where both orders are possible."""
    sign = value[4] if value[4] in "-/." else value[2]
    orders = ("%Y{0}%m{0}%d",) if value[4] == sign else ("%d{0}%m{0}%Y", "%m{0}%d{0}%Y")
    for order in orders:
        style = order.format(sign)
        try:
            return dt.datetime.strptime(value, style).date(), style
        except ValueError:
            continue
    return None


def _valid(kind: str, value: str) -> bool:
    digits = _NOT_DIGIT.sub("", value)
    if kind == "card":
        return luhn_digit(digits[:-1]) == digits[-1] and len(set(digits)) > 1
    if kind == "iban":
        plain = value.replace(" ", "")
        return 15 <= len(plain) <= 34 and iban_digits(plain[:2], plain[4:]) == plain[2:4]
    if kind == "phone":
        return 7 <= len(digits) <= 15
    if kind == "date":
        return _date(value) is not None
    if kind == "secret":
        return any(c.isdigit() for c in value)
    return True


def find(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all values, in order, without overlaps."""
    has_digit = _DIGIT.search(text) is not None
    tries = []
    if "@" in text:
        tries.append(("email", EMAIL, 0))
    if has_digit and ("=" in text or ":" in text):
        tries.append(("secret", SECRET, 1))
    if has_digit:
        tries += [("iban", IBAN, 1), ("ipv4", IPV4, 1), ("card", CARD, 1), ("phone", PHONE, 1), ("ssn", SSN, 1), ("date", DATE, 1)]
    found: list[tuple[int, int, str]] = []
    for kind, pattern, group in tries:
        new = []  # in order, and apart from each other
        for m in pattern.finditer(text):
            start, end = m.span(group)
            at = bisect.bisect_left(found, (end,))  # the last one before it begins before end
            if (not at or found[at - 1][1] <= start) and _valid(kind, m.group(group)):
                new.append((start, end, kind))
        found = sorted(found + new)
    return found


def pseudonymise(text: str | None, pseudonyms: Pseudonyms) -> tuple[str | None, list[dict]]:
    if not text:
        return text, []
    spans = find(text)
    if not spans:
        return text, []
    out, at, told = [], 0, []
    for start, end, kind in spans:
        new = pseudonyms.replace(kind, text[start:end])
        out += [text[at:start], new]
        told.append({"kind": kind, "start": start, "length": end - start, "pseudonym": new})
        at = end
    return "".join(out) + text[at:], told


RESULT = "text string, found array<struct<kind: string, start: int, length: int, pseudonym: string>>"


def replace_personal_data(docs: DataFrame, key: bytes = DEMO_KEY, text: str = "text", found: str | None = "found") -> DataFrame:
    """``docs`` with pseudonyms in ``text``; ``found`` names the column that lists them (None: no such column)."""

    @F.pandas_udf(RESULT)
    def run(texts: pd.Series) -> pd.DataFrame:
        pseudonyms = Pseudonyms(key)
        return pd.DataFrame([pseudonymise(t, pseudonyms) for t in texts], columns=["text", "found"])

    done = docs.withColumn("__done", run(F.col(text)))
    out = [F.col("__done.text").alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns if c != found]
    return done.select(*out, *([F.col("__done.found").alias(found)] if found else []))


def query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return replace_personal_data(docs).withColumn("n_found", F.size("found"))
