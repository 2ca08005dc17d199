"""Column functions for dirty text fields: money, ZIP codes, code lists, matching."""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_money(c, dtype: str = "float") -> Column:
    """'$12,345' -> 12345.0; text that is not a number becomes NULL.

    Removes every '$' and ',' (one ``translate`` instead of two regex passes)
    and casts with ``try_cast`` so dirty input does not raise under ANSI.
    """
    return F.translate(_c(c), "$,", "").try_cast(dtype)


def clean_money_positive(c) -> Column:
    """Strict money parse: trimmed, '$' and ',' removed, double; NULL unless > 0.

    NaN and infinities are rejected as well, so only finite positive amounts pass.
    """
    v = F.translate(F.trim(_c(c).cast("string")), "$,", "").try_cast("double")
    ok = (v > 0) & ~F.isnan(v) & (v != F.lit(float("inf")))
    return F.when(ok, v)


def zip_pad(c, width: int = 5) -> Column:
    """Left-pad with zeros to ``width`` like ``str.zfill``: never truncates,
    keeps a leading sign in front of the zeros, NULL stays NULL."""
    s = _c(c).cast("string")
    first = F.substring(s, 1, 1)
    signed = first.isin("+", "-")
    return (F.when(F.length(s) >= width, s)
            .when(signed, F.concat(first, F.lpad(F.substring(s, 2, 1 << 30), width - 1, "0")))
            .otherwise(F.lpad(s, width, "0")))


def contains_any(c, words: Iterable[str], case_insensitive: bool = True) -> Column:
    """True when the text contains at least one of ``words`` (plain substrings)."""
    s = F.lower(_c(c)) if case_insensitive else _c(c)
    words = [w.lower() if case_insensitive else w for w in words]
    if not words:
        return F.lit(False)
    return reduce(lambda a, b: a | b, [s.contains(w) for w in words])


def matches(c, pattern: str) -> Column:
    """Java-regex search (``rlike``); use ``(?i)`` in the pattern for case folding."""
    return _c(c).rlike(pattern)


def split_codes(c, sep: str = " ") -> Column:
    """Split a separated code list into an array of strings (every separator
    splits, so doubled separators give empty elements)."""
    return F.split(_c(c), sep)


def non_empty(c) -> Column:
    """Python truthiness of a text field: not NULL and not ''."""
    return _c(c).isNotNull() & (_c(c).cast("string") != "")
