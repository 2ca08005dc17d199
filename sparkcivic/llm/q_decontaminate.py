"""op6_decontaminate: benchmark windows found in every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate as dec
from .common import table

NAME = "op6_decontaminate"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dec.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), item_ids=True)
    items = F.array_sort(F.transform("_items", lambda i: i.cast("string")))
    rows = rows.select("doc_id", F.col("_n_words").alias("n_words"), dec.n_hit(F.col("_hits")).alias("n_hit"), items.alias("items"))
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        dec.is_contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"))


LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = "list_filter(regexp_split_to_array(" + LOWER + r", '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

SQL = f"""
WITH d AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
b AS (SELECT item_id, {WORDS.format("coalesce(text, '')")} AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, w[s:s + 12] AS win
       FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 12))) AS s FROM b
             WHERE len(w) > 0 AND item_id IS NOT NULL)),
sizes AS (SELECT DISTINCT len(win) AS n FROM bw),
dw AS (SELECT doc_id, n, s, w[s:s + n - 1] AS win
       FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, n, s, item_id FROM dw JOIN bw USING (win)),
per AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
               string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
        FROM hit GROUP BY doc_id),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN per USING (doc_id) LEFT JOIN pos USING (doc_id)"""
