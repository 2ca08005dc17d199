"""Code dictionary from 'CODE description' text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def code_dictionary(lines: DataFrame, value_col: str = "value", code_type: str = "int") -> DataFrame:
    """``code, description`` from lines split at the first space.

    Empty lines and lines whose first token is not a number are dropped; a
    line with a code and no text keeps a NULL description. Uses ``get`` and
    ``try_cast`` so a one-word or non-numeric line cannot fail the job.
    """
    v = F.col(value_col)
    parts = F.split(v, " ", 2)
    return (lines.filter(v.isNotNull() & (v != ""))
            .select(F.trim(F.get(parts, 0)).try_cast(code_type).alias("code"),
                    F.trim(F.get(parts, 1)).alias("description"))
            .filter(F.col("code").isNotNull()))
