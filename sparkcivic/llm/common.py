"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; every other character stays as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def crc_fold(key: Column, folds: int) -> Column:
    """``crc32(key as text) mod folds``."""
    return F.crc32(key.cast("string").cast("binary")) % F.lit(folds)


def id_text(c: Column) -> Column:
    """A whole-number id as text. Pandas would read ids as floating point as
    soon as one of them is NULL; :func:`whole_ids` gives them back."""
    return c.cast("bigint").cast("string")


def whole_ids(texts) -> list[int | None]:
    return [None if t is None else int(t) for t in texts]


def maybe_broadcast(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """Hints a broadcast only when the counted ``rows`` are within ``limit``;
    beyond it the join stays a shuffle join. The result is the same."""
    return F.broadcast(df) if rows <= limit else df
