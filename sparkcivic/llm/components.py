"""Connected components of a link table as joins and aggregations.

Alternating large-star and small-star steps: every step links a node's
neighbours to the least node in its neighbourhood. Least neighbours are
map-side aggregates and the joins are plain equi joins, so a hub is never
gathered in one task. Each step is written as a table, which cuts lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Both directions of ``u > v`` links in; new ``u > v`` links out."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if large:
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        out = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = links.groupBy("u").agg(F.min("v").alias("m"))
        out = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.where("u > v").distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``id, component`` for every id that has a link; the component is its
    least id. Links with a NULL end or to itself count for nothing."""
    links = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).alias("_a"), F.col(b).alias("_b"))
    links = links.where("_a <> _b").select("u", "v").distinct()
    state = {"n": F.count(F.lit(1)), "s": F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))}
    links, now = materialize(links, "links", state)
    while now["n"]:
        before = now
        links, now = materialize(_star(_star(links, True), False), "links", state)
        if now == before:
            break
    return links.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        links.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
