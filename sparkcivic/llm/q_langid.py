"""op9_langid: language of every document, learned from three quarters of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import langid
from .common import crc_fold, table

NAME = "op9_langid"
SQL = None
FOLDS, HELD_OUT = 4, 2


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(crc_fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    model = langid.fit(docs.where(~held_out))
    rows = langid.identify(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", held_out.alias("held_out"), F.col("_lang.lang").alias("lang_pred"),
                       F.col("_lang.score").alias("score"), F.size("_lang.mixture").cast("bigint").alias("n_langs"))
