"""Code-list membership: rows whose separated code list hits a dictionary."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_codes(df: DataFrame, codes_col: str, keep: Sequence[str], sep: str = " ",
                  code_type: str = "int", code_col: str = "code") -> DataFrame:
    """One row per element of the code list: ``keep`` columns, the element
    text ``code_str`` and its ``try_cast`` to ``code_type`` (NULL when not a
    number). Rows with a NULL list produce no rows."""
    exploded = (df.filter(F.col(codes_col).isNotNull())
                .select(*[F.col(k) for k in keep],
                        F.explode(F.split(F.col(codes_col), sep)).alias("code_str")))
    return exploded.withColumn(code_col, F.col("code_str").try_cast(code_type))


def any_code_match(df: DataFrame, codes_col: str, dictionary: DataFrame, dict_code: str,
                   keep: Sequence[str], sep: str = " ", code_type: str = "int") -> DataFrame:
    """Distinct ``keep`` tuples of rows that carry at least one code present
    in ``dictionary[dict_code]``.

    Plan: explode -> left-semi join on the code -> distinct. The semi join
    never multiplies rows (duplicate dictionary codes are harmless); AQE turns
    it into a broadcast join when the filtered dictionary is small at run time
    and splits a hot code's partition when it is not.
    """
    codes = explode_codes(df, codes_col, keep, sep, code_type, "_code").filter(F.col("_code").isNotNull())
    wanted = dictionary.select(F.col(dict_code).try_cast(code_type).alias("_code"))
    return codes.join(wanted, on="_code", how="left_semi").select(*keep).distinct()
