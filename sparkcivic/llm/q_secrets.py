"""op3_secrets: spans of secrets in every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import secrets
from .common import table

NAME = "op3_secrets"
SQL = None  # SQL has no positions of regular-expression matches


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    # each document is a repository of its own; its source owns it
    rows = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"] != "opaque")
    return rows.select(
        "doc_id", n("assign").alias("n_assign"), n("access").alias("n_access"), n("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: ~s["example"])).cast("bigint").alias("n_live"))
