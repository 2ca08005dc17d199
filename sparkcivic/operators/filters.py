"""Row filters: required fields, coordinate sanity, exclusion lists."""

from __future__ import annotations

from functools import reduce
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import not_null_island
from ..functions.text import non_empty


def require(df: DataFrame, cols: Sequence[str], non_empty_text: bool = False) -> DataFrame:
    """Keep rows where every column in ``cols`` is present.

    ``non_empty_text=True`` also rejects '' (Python truthiness of a field).
    The conjunction reaches the Parquet scan as pushed ``IsNotNull`` filters.
    """
    conds = [non_empty(F.col(f"`{c}`")) if non_empty_text else F.col(f"`{c}`").isNotNull()
             for c in cols]
    return df.filter(reduce(lambda a, b: a & b, conds)) if conds else df


def drop_null_island(df: DataFrame, lat: str = "lat", lon: str = "lon",
                     null_safe: bool = False) -> DataFrame:
    """Remove the (0, 0) placeholder location; see :func:`not_null_island`."""
    return df.filter(not_null_island(F.col(lat), F.col(lon), null_safe=null_safe))


def flag_not_in(c, values: Iterable[str]) -> Column:
    """1 when the value is not one of ``values``, else 0. NULL input gives 0,
    like a CASE WHEN whose condition is unknown."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(~col.isin(list(values)), 1).otherwise(0)
