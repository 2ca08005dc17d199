"""op11_spelling: words of all documents with their spelling variants' forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import spelling
from .common import table

NAME = "op11_spelling"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


# crc32 goes by half bytes, low half first; its table of 16 entries follows from the polynomial
SQL = r"""
WITH RECURSIVE bits AS (
  SELECT i AS k, i AS c, 0 AS step FROM range(16) r(i)
  UNION ALL SELECT k, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, step + 1 FROM bits WHERE step < 4
), crc AS (SELECT list(c ORDER BY k) AS t FROM bits WHERE step = 4),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[a-z\x{00C0}-\x{00FF}]+')) AS run FROM documents)
  GROUP BY ALL
), hexed AS (SELECT *, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM runs),
hashed AS (
  SELECT run, n, xor(list_reduce(list_transform(range(1, length(x) + 1),
      lambda i: CAST(instr('0123456789ABCDEF', substr(x, i + CASE WHEN i % 2 = 1 THEN 1 ELSE -1 END, 1)) - 1 AS BIGINT)),
    lambda c, b: xor(t[(xor(c, b) & 15) + 1], c >> 4), 4294967295), 4294967295) AS h
  FROM hexed, crc
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), cut AS (
  SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM cut a JOIN words b ON a.rest = b.word
), most AS (
  SELECT w.word, w.n, count(*) AS n_near, first(near.near ORDER BY o.n DESC, near.near) AS f, max(o.n) AS fn
  FROM near JOIN words w ON w.word = near.word JOIN words o ON o.word = near.near GROUP BY w.word, w.n
), forms AS (SELECT word, f AS form, fn AS form_n FROM most WHERE fn >= 5 * n),
chain AS (
  SELECT word, form AS root FROM forms UNION SELECT chain.word, forms.form FROM chain JOIN forms ON forms.word = chain.root
), ends AS (SELECT word, root FROM chain WHERE root NOT IN (SELECT word FROM forms))
SELECT w.word, forms.form, coalesce(ends.root, w.word) AS root, w.n, coalesce(most.n_near, 0) AS n_near, forms.form_n
FROM words w LEFT JOIN most USING (word) LEFT JOIN forms USING (word) LEFT JOIN ends USING (word)"""
