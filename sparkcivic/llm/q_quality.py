"""op7_quality: probability that a document is good, learned from two thirds of the labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from . import quality
from .common import crc_fold, table

NAME = "op7_quality"
SQL = None
FOLDS, HELD_OUT = 3, 1


def scored(spark: SparkSession, docs: DataFrame, sf_dir: str, keep: list[str]) -> DataFrame:
    """The ``keep`` columns of ``docs`` (``doc_id`` among them) and ``_score``;
    learned from the labelled rows of ``docs`` outside the held-out fold. What
    is kept is written once with the statistics, as both steps read them."""
    rows = materialize(docs.select(*keep, quality.document_statistics(F.col("text")).alias("_stats")), "statistics")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("_labelled"), F.col("quality").alias("_label"))
    learn = rows.where(crc_fold(F.col("doc_id"), FOLDS) != HELD_OUT).select("doc_id", "_stats")
    model = quality.fit(learn.join(labels, F.col("doc_id") == F.col("_labelled")), "_label")
    return rows.withColumn("_score", quality.score(model, F.col("_stats"))).drop("_stats")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(spark, table(spark, sf_dir, "documents"), sf_dir, ["doc_id"])
    return rows.select("doc_id", F.coalesce(crc_fold(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                       F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted"))
