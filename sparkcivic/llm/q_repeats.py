"""op13_repeats: documents without passages of 50 words that start in an earlier document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import repeats
from .common import table

NAME = "op13_repeats"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), win AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
), lead AS (SELECT g, min(doc_id) AS f FROM win GROUP BY g HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, i FROM win JOIN lead USING (g) WHERE doc_id > f),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
marked AS (
  SELECT words.doc_id, word, p, coalesce(p - max(i) OVER (PARTITION BY words.doc_id ORDER BY p), 50) >= 50 AS kept
  FROM words LEFT JOIN gone ON gone.doc_id = words.doc_id AND gone.i = p
), s AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (NOT kept) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (kept) AS t FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN s USING (doc_id)"""
