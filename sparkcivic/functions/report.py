"""Report formatting done as columns on the executors, not in driver loops."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fixed_decimals(c, digits: int) -> Column:
    """Text with exactly ``digits`` decimals, rounded HALF_UP first so the
    printed digits do not depend on binary representation."""
    col = _c(c)
    return F.when(col.isNotNull(), F.format_string(f"%.{digits}f", F.round(col, digits)))


def rank_label(c, prefix: str = "#") -> Column:
    return F.concat(F.lit(prefix), _c(c).cast("string"))


def csv_line(*cols, sep: str = ",") -> Column:
    """One text line from several columns; NULL parts become empty fields
    (``concat`` would turn the whole line NULL)."""
    return F.concat_ws(sep, *[F.coalesce(_c(x).cast("string"), F.lit("")) for x in cols])
