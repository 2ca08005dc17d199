"""Samples of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_sample(key, fraction: float) -> Column:
    """Whether a row's key falls into the sample: the first eight digits of
    the MD5 of the key's text, as a number below ``fraction`` of its range. The
    same rows are drawn for any partitioning, and by any engine. A NULL key is
    never drawn."""
    col = F.col(key) if isinstance(key, str) else key
    drawn = F.conv(F.substring(F.md5(col.cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint")
    return F.coalesce(drawn < int(fraction * 2 ** 32), F.lit(False))


def sample_by_key(df: DataFrame, key: str, fraction: float | None) -> DataFrame:
    """The rows whose key is in the sample; all rows without a fraction."""
    return df if fraction is None else df.filter(in_sample(key, fraction))


def sample_rows(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Bernoulli sample; which rows are drawn depends on the partitioning."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)
