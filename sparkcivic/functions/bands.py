"""Banding of a numeric column into labelled ranges."""

from __future__ import annotations

from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Victim age bands, checked in order; the first matching
# (label, operator, bound) wins, anything above the last bound is the
# "otherwise" band. Ages of 0 and below fall into the first band.
AGE_BANDS: tuple[tuple[str, str, int], ...] = (
    ("Children", "<", 18),
    ("Young Adults", "<=", 24),
    ("Adults", "<=", 64),
)
AGE_OTHERWISE = "Elderly"
UNKNOWN = "Unknown"
WHOLE_NUMBER = r"[\x00-\x20]*[+-]?[0-9]+[\x00-\x20]*"  # what a cast to a whole number accepts

_OPS = {
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def band(c, bands: Sequence[tuple[str, str, float]] = AGE_BANDS,
         otherwise: str = AGE_OTHERWISE) -> Column:
    """Native CASE WHEN chain; NULL input gives NULL (no band)."""
    col = _c(c)
    expr = None
    for label, op, bound in bands:
        cond = _OPS[op](col, bound)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return F.when(col.isNotNull(), expr.otherwise(otherwise))


def band_safe(c, bands: Sequence[tuple[str, str, float]] = AGE_BANDS,
              otherwise: str = AGE_OTHERWISE, unknown: str = UNKNOWN) -> Column:
    """Band of a value that may be text: whole numbers of up to 64 bits are
    banded; all else (NULL, '', 'abc', '12.0', '1e1', 'inf') becomes ``unknown``."""
    return F.coalesce(band(_c(c).cast("string").try_cast("bigint"), bands, otherwise), F.lit(unknown))


def _band_series(values: pd.Series, bands, otherwise, unknown) -> pd.Series:
    text = values.fillna("").astype(str)
    whole = text.str.fullmatch(WHOLE_NUMBER)
    num = text.where(whole, "0").map(int)  # unbounded, so the range test is exact
    whole &= num.map(lambda n: -2 ** 63 <= n < 2 ** 63).astype(bool)
    conds, labels = [], []
    for label, op, bound in bands:
        conds.append(num.map(lambda n: n < bound if op == "<" else n <= bound).to_numpy(dtype=bool))
        labels.append(label)
    out = np.select(conds, labels, default=otherwise) if len(values) else np.array([], dtype=object)
    return pd.Series(np.where(whole, out, unknown), index=values.index)


def band_udf(bands: Sequence[tuple[str, str, float]] = AGE_BANDS,
             otherwise: str = AGE_OTHERWISE, unknown: str = UNKNOWN):
    """The Python-side twin of :func:`band_safe` as an Arrow-batched pandas UDF,
    a function of one column. The column goes over as text, like there.

    Kept for native-vs-UDF comparisons; the native form is the default.
    """
    bands = tuple(bands)

    @F.pandas_udf("string")
    def _udf(values: pd.Series) -> pd.Series:
        return _band_series(values, bands, otherwise, unknown)

    # Declared non-deterministic only so that a filter on the result is not
    # pushed below the projection with its own copy of the UDF (which would
    # run the Python worker twice per row).
    udf = _udf.asNondeterministic()
    return lambda c: udf(_c(c).cast("string"))
