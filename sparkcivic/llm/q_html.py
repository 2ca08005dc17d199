"""op2_html: main text of every page."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import html_text
from .common import table

NAME = "op2_html"
SQL = None


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select("page_id", "url", html_text.main_text(F.col("html")).alias("text"))
    return rows.withColumn("n_chars", F.char_length("text").cast("bigint"))
