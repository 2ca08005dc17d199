"""Format-preserving pseudonyms for personal data.

Found values are replaced by another value of the same format, chosen by a
keyed permutation of all values of that format: a Feistel network over the
format's numbering, walked on until it falls inside (cycle walking). The same
value therefore gets the same pseudonym in every document, without any table
of values, so each document is treated on its own and nothing is shuffled.

What is validated before it counts:
  card   13 to 19 digits, in one run or in groups, with a right check digit
         and a card issuer's first digit; issuer digit and check rule are kept
  phone  international or area-code style groups with 10 to 15 digits;
         the country code and all signs between digits are kept; a number
         without country code is permuted as the same number behind +1
  ssn    3-2-4 groups outside the ranges that are never issued
  iban   2 letters, check digits and account with a remainder of 1; country
         and check rule are kept
  ip     four numbers up to 255 that are not part of a longer number
  date   year-month-day, day/month/year or month/day/year with a real day in
         1900-2099; it stays a real day in the same notation. A day gets the same
         new day in every notation: what a notation can show of it is kept, which
         is whether its month is over 9 and its day up to 9, 10 to 12 or over 12
  email  name and host below the last label: letters stay letters, digits
         digits; the last label (and a second one that belongs to it) is kept

What follows a value may look like a part of it (``+1 (499) 555-6503 2024``,
``BE68 5390 0754 7034 BIC``). A match may therefore end at any separator in it:
first where the length is the country's, or a phone's (3) 3-4 groups are full,
then from the longest end to the shortest that is valid. A match without any
valid end is searched again from its next character.

Not found, and left as they are: bare runs of nine or ten digits, national
numbers in other groups, lower-case IBANs, IPv6, dates with names of months.
Numbers with and without a trunk digit, ``+44 (0)20``, are not linked.

Defined results
  * NULL text stays NULL, with no findings; empty text stays empty.
  * Every row gives one row, repeated rows and equal or NULL ids included.
  * Of overlapping findings the leftmost counts, then the longest.
  * An empty table gives an empty result. ``pseudonymise`` replaces the text
    column in place and adds ``_pii``; further columns are left alone.
  * Undoing reads the same spans again, but for a card (or an IBAN of a country
    that is not listed) beside bare numbers that by chance, 1 in 10 (1 in 97),
    are valid together with the pseudonym.
  * A value may fall on itself with one chance in the size of its format.
"""

from __future__ import annotations

import datetime
import hashlib
import re
import string
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("card", "phone", "ssn", "iban", "ip", "date", "email")
ROUNDS = 8
ANY = re.compile(r"[0-9@]")
EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}(?![A-Za-z0-9-])")
CARD = re.compile(r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])")
PHONE = re.compile(r"(?<![0-9+.])(?:\+[0-9]{1,3}[ .-]?)(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9])"
                   r"|(?<![0-9+.])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
IP = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])")
DATE = re.compile(r"(?<![0-9./-])(?:[0-9]{4}([-/.])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([-/.])[0-9]{1,2}\2[0-9]{4})(?![0-9]|[./-][0-9])")
PHONE_HEAD = re.compile(r"\+[0-9]{1,3}(?=[^0-9])|\+1|\+[0-9]{2}|")
TRUNK = re.compile(r"[ .-]?\([0-9]\)")
NUMBER_GOES_ON = re.compile(r"[./-][0-9]")
AREA_GROUPS = re.compile(r"\+[0-9]{1,3}[ .-]?\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])")
IBAN_LENGTHS = {x[:2]: int(x[2:]) for x in """AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22
DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28
LC32 LI21 LT20 LU20 LV21 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19
SK24 SM27 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20""".split()}
# Digits after the country code, without a trunk digit in brackets.
PHONE_LENGTHS = {f"+{c}": tuple(map(int, n.split("/"))) for c, n in (x.split(":") for x in """1:10 7:10 27:9 30:10 31:9 32:9/8 33:9
34:9 36:9/8 40:9 41:9 44:10/9 45:8 46:9/8/7 47:8 48:9 52:10 55:11/10 61:9 65:8 81:10/9 82:10/9/8 86:11/10 90:10 91:10 351:9
353:9/8/7 420:9 852:8 971:9/8 972:9/8""".split())}
FIRST_DAY, DAYS = datetime.date(1900, 1, 1).toordinal(), 73049  # to 2099-12-31


class Permutation:
    """Keyed permutations of ``range(size)``, one for each label."""

    def __init__(self, key: bytes):
        self.key = hashlib.sha256(key).digest()

    def _round(self, label: str, i: int, half: int, bits: int) -> int:
        said = f"{label}|{i}|{half}".encode()
        out = hashlib.blake2b(said, key=self.key, digest_size=min(64, bits // 8 + 9)).digest()
        return int.from_bytes(out, "big") & ((1 << bits) - 1)

    def __call__(self, label: str, size: int, value: int, back: bool = False) -> int:
        if size < 2:
            return value
        bits = max(1, -(-(size - 1).bit_length() // 2))
        mask = (1 << bits) - 1
        while True:
            a, b = value >> bits, value & mask
            for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
                if back:
                    a, b = b ^ self._round(label, i, a, bits), a
                else:
                    a, b = b, a ^ self._round(label, i, b, bits)
            value = a << bits | b
            if value < size:
                return value


def _luhn(digits: str) -> int:
    """What the last digit would have to be added to a zero for a right sum."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return -total % 10


def _fill(form: str, digits: str) -> str:
    """The digits of ``form`` replaced in order; other signs stay."""
    it = iter(digits)
    return "".join(next(it) if c in string.digits else c for c in form)


def _digits(p: Permutation, label: str, digits: str, back: bool) -> str:
    return str(p(f"{label}|{len(digits)}", 10 ** len(digits), int(digits), back)).zfill(len(digits)) if digits else ""


def card(p: Permutation, s: str, back: bool) -> str | None:
    d = "".join(c for c in s if c.isdigit())
    if not 13 <= len(d) <= 19 or d[0] not in "23456" or _luhn(d):
        return None
    body = d[0] + _digits(p, f"card{d[0]}", d[1:-1], back)
    return _fill(s, body + str(_luhn(body + "0")))


def phone(p: Permutation, s: str, back: bool) -> str | None:
    m = PHONE_HEAD.match(s)
    head, rest = s[:m.end()], s[m.end():]
    d = "".join(c for c in rest if c.isdigit())
    if not 10 <= len(d) + len(head.lstrip("+")) <= 15 or len(d) < 7:
        return None
    return head + _fill(rest, _digits(p, f"phone{head or '+1'}", d, back))


def ssn(p: Permutation, s: str, back: bool) -> str | None:
    a, b, c = map(int, s.split("-"))
    if a in (0, 666) or a >= 900 or not b or not c:
        return None
    n = ((a - 1 - (a > 666)) * 99 + b - 1) * 9999 + c - 1
    n, c = divmod(p("ssn", 898 * 99 * 9999, n, back), 9999)
    a, b = divmod(n, 99)
    a += 1
    return f"{a + (a >= 666):03}-{b + 1:02}-{c + 1:04}"


def _iban_rest(body: str, country: str) -> int:
    return int("".join(str(int(c, 36)) for c in body + country + "00")) % 97


def iban(p: Permutation, s: str, back: bool) -> str | None:
    flat = s.replace(" ", "")
    country, check, body = flat[:2], flat[2:4], flat[4:]
    if not 11 <= len(body) <= 30 or int(check) != 98 - _iban_rest(body, country):
        return None
    new = _mixed(p, f"iban{country}", body, back)
    new = iter(f"{country}{98 - _iban_rest(new, country):02}{new}")
    return "".join(c if c == " " else next(new) for c in s)


def ip(p: Permutation, s: str, back: bool) -> str | None:
    parts = s.split(".")
    if any(int(x) > 255 or len(x) > 1 and x[0] == "0" for x in parts):
        return None
    n = p("ip", 1 << 32, int.from_bytes(bytes(map(int, parts)), "big"), back)
    return ".".join(map(str, n.to_bytes(4, "big")))


def date(p: Permutation, s: str, back: bool) -> str | None:
    sep = next(c for c in s if not c.isdigit())
    parts = s.split(sep)
    orders = ["ymd"] if len(parts[0]) == 4 else ["dmy", "mdy"]
    for order in orders:
        v = {k: int(x) for k, x in zip(order, parts)}
        try:
            day = datetime.date(v["y"], v["m"], v["d"]).toordinal() - FIRST_DAY
        except ValueError:
            continue
        if 0 <= day < DAYS:
            new = _new_day(p, day, back)
            return sep.join(str(getattr(new, {"y": "year", "m": "month", "d": "day"}[k])).zfill(len(x)) for k, x in zip(order, parts))
    return None


def _shown(day: datetime.date) -> tuple[bool, int]:
    """What must stay for a new day to be read back from the same notation:
    the lengths of its numbers, and that month-first dates have days over 12."""
    return day.month > 9, (day.day > 9) + (day.day > 12)


def _new_day(p: Permutation, day: int, back: bool) -> datetime.date:
    kept = _shown(datetime.date.fromordinal(FIRST_DAY + day))
    while True:
        day = p("date", DAYS, day, back)
        new = datetime.date.fromordinal(FIRST_DAY + day)
        if _shown(new) == kept:
            return new


def _mixed(p: Permutation, label: str, s: str, back: bool) -> str:
    """Letters to letters of the same case and digits to digits, as one number."""
    sets = [next((a for a in (string.digits, string.ascii_lowercase, string.ascii_uppercase) if c in a), c) for c in s]
    form = "".join(a[0] for a in sets)
    n, size = 0, 1
    for c, a in zip(s, sets):
        n, size = n * len(a) + a.index(c), size * len(a)
    n, out = p(f"{label}|{form}", size, n, back), []
    for a in reversed(sets):
        n, i = divmod(n, len(a))
        out.append(a[i])
    return "".join(reversed(out))


def email(p: Permutation, s: str, back: bool) -> str | None:
    name, host = s.rsplit("@", 1)
    labels = host.split(".")
    kept = 2 if len(labels) > 2 and len(labels[-1]) == 2 and len(labels[-2]) <= 3 else 1
    own = ".".join(labels[:-kept])
    new = _mixed(p, "email", f"{name}@{own}", back)
    return f"{new}.{'.'.join(labels[-kept:])}"


def _separator_ends(s: str) -> list[int]:
    """Lengths at which ``s`` can end before a separator, longest first."""
    return [k for k in range(len(s), 0, -1) if s[k - 1].isalnum() and not s[k:k + 1].isalnum()]


def _whole(s: str, after: str) -> list[int]:
    return [len(s)]


def _phone_ends(s: str, after: str) -> list[int]:
    if s[0] != "+":
        return [len(s)]
    full = AREA_GROUPS.match(s)
    if full:
        return [full.end()]
    head = PHONE_HEAD.match(s)[0]
    trunk = bool(TRUNK.match(s, len(head)))
    lengths = PHONE_LENGTHS.get(head, ())
    count = lambda k: sum(c.isdigit() for c in s[len(head):k]) - trunk
    cut = lambda k: bool(NUMBER_GOES_ON.match(s[k:] + after))
    return sorted(_separator_ends(s), key=lambda k: (count(k) not in lengths, cut(k)))


def _iban_ends(s: str, after: str) -> list[int]:
    length = IBAN_LENGTHS.get(s[:2])
    return sorted(_separator_ends(s), key=lambda k: k - s.count(" ", 0, k) != length)


ENDS: dict[str, Callable[[str, str], list[int]]] = {"phone": _phone_ends, "iban": _iban_ends}
FORMATS: tuple[tuple[str, re.Pattern, Callable], ...] = (
    ("email", EMAIL, email), ("iban", IBAN, iban), ("card", CARD, card), ("ip", IP, ip), ("ssn", SSN, ssn),
    ("date", DATE, date), ("phone", PHONE, phone))


def _first(text: str, at: int, kind: str, pattern: re.Pattern, change: Callable, p: Permutation, back: bool) -> tuple | None:
    """The first valid value from ``at`` on, as ``(start, -end, kind, new)``."""
    ends = ENDS.get(kind, _whole)
    while m := pattern.search(text, at):
        for k in ends(m[0], text[m.end():m.end() + 2]):
            new = change(p, m[0][:k], back)
            if new is not None:
                return m.start(), -m.start() - k, kind, new
        at = m.start() + 1
    return None


def replace(text: str, p: Permutation, back: bool = False) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and ``(kind, start, end)`` in the old text."""
    if not ANY.search(text):
        return text, []
    out, at, spans = [], 0, []
    first = {f: _first(text, 0, *f, p, back) for f in FORMATS if f[0] != "email" or "@" in text}
    while first := {f: hit for f, hit in first.items() if hit}:
        start, end, kind, new = min(first.values())
        out += [text[at:start], new]
        at = -end
        spans.append((kind, start, at))
        first = {f: hit if hit[0] >= at else _first(text, at, *f, p, back) for f, hit in first.items()}
    return "".join([*out, text[at:]]), spans


FOUND = T.StructType([T.StructField("text", T.StringType()), T.StructField("found", T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))])


def _replaced(text: Column, key: str, back: bool) -> Column:
    @F.pandas_udf(FOUND)
    def run(texts: pd.Series) -> pd.DataFrame:
        p = Permutation(key.encode())
        rows = [(t, []) if t is None else replace(t, p, back) for t in texts.tolist()]
        return pd.DataFrame({"text": [t for t, _ in rows], "found": [
            [{"kind": k, "start": a, "end": b} for k, a, b in s] for _, s in rows]}, dtype=object)
    return run(text)


def pseudonymise(df: DataFrame, key: str, text: str = "text", back: bool = False) -> DataFrame:
    """``df`` with pseudonyms in ``text`` and ``_pii``, the found spans
    (``kind, start, end`` in the old text; it replaces a column of that name). ``key`` is secret; ``back`` undoes
    a replacement with the same key."""
    names = [c for c in df.columns if c not in ("_pii", "_pii_new")]
    df = df.withColumn("_pii_new", _replaced(F.col(text), key, back))
    return df.select(*[F.col("_pii_new.text").alias(text) if c == text else F.col(c) for c in names],
                     F.col("_pii_new.found").alias("_pii"))
