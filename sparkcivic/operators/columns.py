"""Schema-level operators: name normalisation, drift-tolerant lookup, typed projection."""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def trim_names(df: DataFrame) -> DataFrame:
    """Strip surrounding whitespace from every column name in one projection.

    Raises ``ValueError`` when two names collide after stripping instead of
    silently producing an ambiguous frame.
    """
    new = [c.strip() for c in df.columns]
    if new == df.columns:
        return df
    seen: set[str] = set()
    for n in new:
        if n in seen:
            raise ValueError(f"column name {n!r} occurs twice after trimming")
        seen.add(n)
    return df.toDF(*new)


def first_present_column(df: DataFrame, names: Sequence[str]) -> Column:
    """Column for the first of ``names`` that exists in the schema (decided
    at plan time, so its value is used even when NULL); a NULL literal when
    none exists."""
    for n in names:
        if n in df.columns:
            return F.col(f"`{n}`")
    return F.lit(None)


def project_cast(df: DataFrame, spec: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Select ``{out_name: (source_name, type)}`` with ``try_cast`` so that
    text that does not fit the type becomes NULL instead of failing the job."""
    return df.select([F.col(f"`{src}`").try_cast(t).alias(out) for out, (src, t) in spec.items()])
