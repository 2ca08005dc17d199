"""Grouped aggregates used by the analyses."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, keys: Sequence[str], count_col: str = "count") -> DataFrame:
    """Row count per key (partial counts are combined map-side)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))


def rate_by_group(df: DataFrame, keys: Sequence[str], flag: Column | str,
                  total_col: str = "total", hit_col: str = "closed",
                  rate_col: str = "rate", scale: float = 100.0,
                  decimal_digits: int | None = None) -> DataFrame:
    """Per group: row count, sum of a 0/1 flag, and ``scale * hits / total``.

    ``decimal_digits=None`` computes the rate in double arithmetic;
    an integer computes it in exact decimal arithmetic rounded HALF_UP to
    that many digits and returns it as double.
    """
    f = F.col(flag) if isinstance(flag, str) else flag
    agg = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(total_col), F.sum(f).alias(hit_col))
    if decimal_digits is None:
        rate = F.col(hit_col) / F.col(total_col) * F.lit(scale)
    else:
        # a literal like 100.0 is a decimal in Spark SQL, so the whole
        # expression stays in exact decimal arithmetic until the cast
        rate = F.expr(f"cast(round({float(scale)!r} * `{hit_col}` / `{total_col}`, "
                      f"{int(decimal_digits)}) as double)")
    return agg.withColumn(rate_col, rate)


def exact_mean(value: Column, digits: int) -> Column:
    """Mean rounded HALF_UP to ``digits``, the same whatever the order and the
    partitions of the rows: values are taken to 12 decimals, their sum is exact.
    Groups with a value that has no such form (NaN, infinite, beyond 26 digits)
    get the mean of floating-point sums."""
    whole = value.try_cast("decimal(38,12)")
    count = F.count(value)
    plain = F.avg(value.cast("double"))
    mean = (F.try_sum(whole) / count).cast("decimal(38,12)")
    odd = F.count_if(value.isNotNull() & whole.isNull()) > 0
    return F.when(odd, F.round(plain, digits)).when(count > 0, F.coalesce(F.round(mean, digits).cast("double"), F.round(plain, digits)))


def mean_rounded(df: DataFrame, keys: Sequence[str], value: str, digits: int = 3,
                 mean_col: str = "mean", count_col: str | None = "count") -> DataFrame:
    """Rounded mean (and optionally the row count) per key, exact: see :func:`exact_mean`."""
    aggs = [exact_mean(F.col(value), digits).alias(mean_col)]
    if count_col:
        aggs.append(F.count(F.lit(1)).alias(count_col))
    return df.groupBy(*keys).agg(*aggs)
