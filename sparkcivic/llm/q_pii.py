"""op8_pii: all documents with pseudonyms for personal data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import pii
from .common import table

NAME = "op8_pii"
SQL = None  # a keyed permutation; see the tests
KEY = "set a secret key here in production"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), KEY)
    n = lambda kind: F.size(F.filter("_pii", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return rows.select("doc_id", "text", F.size("_pii").cast("bigint").alias("n_found"), *map(n, pii.KINDS))
