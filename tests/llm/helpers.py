"""Small inputs shared by the tests."""

import pyarrow.parquet as pq

from conftest import SF001  # noqa: F401

DOC = "doc_id long, text string, lang string, source string, n_chars long"
#: names that the operators use inside
CLASH = ["id", "n", "component", "term", "pos", "start", "_text", "_id", "_row", "_score", "_stats", "_pii", "_hits", "block",
         "piece", "shard", "spans", "value", "lang_pred", "query_id", "rank"]


def docs(spark, texts, clash=False, first=0):
    """``texts``: text, or (doc_id, text)."""
    rows = [t if isinstance(t, tuple) else (first + i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(i, t, "en", f"src{k % 3}", len(t or "")) for k, (i, t) in enumerate(rows)], DOC)
    if clash:
        from pyspark.sql import functions as F
        for c in CLASH:
            df = df.withColumn(c, F.lit("x"))
    return df


def table(name, sf=SF001):
    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()
