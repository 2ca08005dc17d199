"""Benchmark decontamination with a distributed positional inverted index.

Built from DataFrame functions only. The documents are read three times, and
their texts are shuffled only where the candidates are too large to broadcast:

1. ``term_counts``: how often each test term occurs in the documents.
2. ``build_index``: postings ``(term, doc_id, pos)`` of the rarest terms of
   each test window, written as a table. Frequent terms are never posted.
3. ``contamination``: the postings of a window's rarest term, less its offset
   in the window, are the places looked at; only those where the next terms of
   the window are posted at their offsets remain. The other terms are then
   compared at their places in the documents that are left.
4. ``with_items``: the items of the windows found. A window may be in any
   number of items, so their ids are in no window and no candidate: they are
   joined at the end, once for each distinct set of windows that documents hold.

Test windows are as many as the benchmark has words; terms, windows, candidates
and items are broadcast only if their measured bytes are within
``BROADCAST_BYTES`` and joined by shuffle otherwise. Postings of a frequent term
spread over all tasks: the first join deals by nothing but the documents' own
partitions, the second by document, term and place.

Words are the maximal runs of a-z, 0-9 and non-ASCII characters after
lower-casing A-Z. Text is cut before it is lower-cased, as case does not move
word borders; documents' words and test terms are both lower-cased one by one
(lower-casing a whole text depends on the neighbours of a Greek sigma). This
key can only add candidates, and the last comparison uses the A-Z rule.

Defined results
  * NULL or empty text: no words, no hits. A document row gives one result
    row, repeated rows and NULL ids included (a NULL id has no hits).
  * Items without words and items with a NULL id take no part; equal windows
    of several items count for each of them; repeated items count once.
  * Empty documents or benchmark: an empty result, or one without hits.
  * Only the id and text columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..session import materialize
from .common import ascii_lower, maybe_broadcast

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 13
RAREST = 3  # terms of a window that are posted and intersected
BROADCAST_BYTES = 64 << 20


def words(text: Column) -> Column:
    """Array of the words of a text in its own case; empty for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def _weight(*texts: str) -> Column:
    """Bytes of all rows with these texts, with room for the rest of a row."""
    return F.sum(sum((F.octet_length(t) for t in texts), F.lit(128)).cast("bigint"))


def _bounded(df: DataFrame, *texts: str) -> DataFrame:
    """Broadcast if the measured bytes of its ``texts`` and rows allow it."""
    return maybe_broadcast(df, df.agg(_weight(*texts)).first()[0] or 0, BROADCAST_BYTES)


def _item_windows(items: DataFrame, item: str, text: str, width: int) -> DataFrame:
    w = items.where(F.col(item).isNotNull()).select(F.col(item).alias("item"), words(ascii_lower(F.col(text))).alias("all"))
    w = w.where(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("all") - (width - 1)))
    return w.select("item", "all", F.explode(starts).alias("s")).select("item", F.slice("all", F.col("s"), width).alias("words"))


def test_windows(items: DataFrame, item: str = "item_id", text: str = "text", width: int = WINDOW) -> DataFrame:
    """Distinct windows as a written table: ``wid, words`` and ``phrase`` (the
    words with blanks between them)."""
    w = _item_windows(items, item, text, width).select("words").distinct()
    return materialize(w.select(F.monotonically_increasing_id().alias("wid"), "words", F.array_join("words", " ").alias("phrase")), "windows")


def window_items(items: DataFrame, windows: DataFrame, item: str = "item_id", text: str = "text", width: int = WINDOW) -> DataFrame:
    """``wid, item``: which items hold which window."""
    held = _item_windows(items, item, text, width).select("item", F.array_join("words", " ").alias("phrase"))
    return held.join(_bounded(windows.select("wid", "phrase"), "phrase"), "phrase").select("wid", "item").distinct()


def term_counts(docs: DataFrame, windows: DataFrame, text: str = "text") -> DataFrame:
    """``term, n``: occurrences in the documents of every test term."""
    terms = windows.select(F.explode("words").alias("term")).select(F.lower("term").alias("term")).distinct()
    seen = docs.select(F.explode(words(F.col(text))).alias("term")).select(F.lower("term").alias("term"))
    seen = seen.join(_bounded(terms, "term"), "term", "left_semi")
    return terms.join(seen.groupBy("term").agg(F.count(F.lit(1)).alias("n")), "term", "left").na.fill(0, ["n"])


def plan_windows(windows: DataFrame, counts: DataFrame, rarest: int = RAREST) -> DataFrame:
    """Adds ``lead``: the ``rarest`` (offset, term) of each window, rarest first."""
    t = windows.select("wid", F.posexplode("words").alias("off", "term")).withColumn("term", F.lower("term"))
    t = t.join(counts, "term").groupBy("wid").agg(
        F.slice(F.array_sort(F.collect_list(F.struct("n", "off", "term"))), 1, rarest).alias("lead"))
    return windows.join(t, "wid")


def build_index(docs: DataFrame, planned: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The positional index as a written table: ``term, doc_id, pos`` of every
    occurrence of the windows' rarest terms."""
    terms = planned.select(F.explode("lead.term").alias("term")).distinct()
    terms = _bounded(terms, "term")
    posted = docs.select(F.col(doc).alias("doc_id"), F.posexplode(words(F.col(text))).alias("pos", "term")).withColumn("term", F.lower("term"))
    return materialize(posted.join(terms, "term", "left_semi").select("term", "doc_id", "pos"), "postings")


def phrase_candidates(index: DataFrame, planned: DataFrame) -> DataFrame:
    """``doc_id, wid, start``: places where the rarest terms of a window stand
    at its offsets. The posting list of the rarest term proposes them, and they
    meet the lists of all its posted terms at the adjusted places."""
    first = F.col("lead")[0]
    lead = _bounded(planned.select("wid", "lead", first["term"].alias("term"), first["off"].alias("off"), "phrase"), "phrase").drop("phrase")
    at = index.join(lead, "term").select("doc_id", "wid", "lead", (F.col("pos") - F.col("off")).alias("start")).where("start >= 0")
    at = at.select("doc_id", "wid", "start", F.size("lead").alias("need"), F.explode("lead").alias("t"))
    at = at.select("doc_id", "wid", "start", "need", F.col("t.term").alias("term"), (F.col("start") + F.col("t.off")).alias("pos"))
    met = at.join(index, ["doc_id", "term", "pos"]).groupBy("doc_id", "wid", "start", "need").agg(F.count(F.lit(1)).alias("n"))
    return met.where(F.col("n") >= F.col("need")).select("doc_id", "wid", "start")


def proximity_matches(index: DataFrame, planned: DataFrame, slop: int = 20) -> DataFrame:
    """``doc_id, wid, start, span``: stretches of at most ``slop`` words that
    hold all posted terms of a window in any order, one for each end place.
    Runs over the posting lists only."""
    lead = planned.select("wid", F.size(F.array_distinct("lead.term")).alias("need"),
                          F.explode(F.array_distinct("lead.term")).alias("term"))
    hits = index.join(_bounded(lead, "term"), "term").distinct()
    near = W.partitionBy("doc_id", "wid").orderBy("pos").rangeBetween(-(slop - 1), 0)
    last = W.partitionBy("doc_id", "wid", "term").orderBy("pos").rowsBetween(0, 0)
    hits = hits.withColumn("seen", F.collect_list(F.struct("term", "pos")).over(near)).withColumn("here", F.max("pos").over(last))
    latest = F.transform(F.array_distinct(F.transform("seen", lambda x: x["term"])), lambda t: F.array_max(
        F.transform(F.filter("seen", lambda x: x["term"] == t), lambda x: x["pos"])))
    hits = hits.withColumn("latest", latest).where(F.size("latest") >= F.col("need"))
    return hits.select("doc_id", "wid", F.array_min("latest").alias("start"),
                       (F.col("here") - F.array_min("latest") + 1).alias("span")).distinct()


def contamination(docs: DataFrame, items: DataFrame, doc: str = "doc_id", text: str = "text",
                  item: str = "item_id", item_text: str = "text", width: int = WINDOW,
                  keep: list[str] | None = None, item_ids: bool = False) -> DataFrame:
    """One row per document row: the ``keep`` columns, ``_n_words`` and
    ``_hits``, an array of ``start, n, wid`` for each window occurrence, and
    with ``item_ids`` also ``_items``, the sorted ids of the items whose
    windows occur (these replace columns of their names)."""
    windows = test_windows(items, item, item_text, width)
    planned = materialize(plan_windows(windows, term_counts(docs, windows, text)), "planned")
    found = phrase_candidates(build_index(docs, planned, doc, text), planned)
    known = planned.select("wid", "phrase", F.size("words").alias("n"))
    found = found.join(_bounded(known, "phrase"), "wid").groupBy("doc_id").agg(
        F.collect_set(F.struct("start", "n", "phrase", "wid")).alias("_found"))
    held = F.aggregate("_found", F.lit(128).cast("bigint"), lambda n, f: n + 64 + F.octet_length(f["phrase"]))
    found, size = materialize(found, "candidates", {"bytes": F.sum(held)})
    found = found.withColumnRenamed("doc_id", "_found_id")
    own = [F.col(c) for c in keep or [doc] if c not in ("_n_words", "_hits", "_items", "_set")]
    rows = docs.select(F.struct(*own).alias("_row"), F.col(doc).alias("_id"), F.col(text).alias("_text"))
    rows = rows.join(maybe_broadcast(found, size["bytes"] or 0, BROADCAST_BYTES), F.col("_id") == F.col("_found_id"), "left")
    lower = F.when(F.col("_found").isNotNull(), words(ascii_lower(F.col("_text"))))  # only where there are candidates
    rows = rows.withColumn("_n_words", F.size(words(F.col("_text"))).cast("bigint")).withColumn("_words", lower)
    hits = F.filter("_found", lambda f: F.array_join(F.slice("_words", f["start"] + 1, f["n"]), " ") == f["phrase"])
    hits = F.transform(hits, lambda f: F.struct(f["start"].alias("start"), f["n"].alias("n"), f["wid"].alias("wid")))
    rows = rows.withColumn("_hits", F.coalesce(hits, F.array().cast("array<struct<start:int,n:int,wid:bigint>>"))) \
        .select("_row.*", "_n_words", "_hits")
    return with_items(rows, window_items(items, windows, item, item_text, width)) if item_ids else rows


def with_items(rows: DataFrame, links: DataFrame) -> DataFrame:
    """Adds ``_items`` to rows with ``_hits``; ``links``: ``wid, item``. Rows
    are written once, with all their columns. Many documents hold the same
    windows (a passage of thousands of items, say), so items are gathered per
    set of windows, named by its digest, and not per document."""
    wids = F.array_sort(F.array_distinct(F.transform("_hits", lambda h: h["wid"])))
    rows = materialize(rows, "hits")
    named = rows.withColumn("_set", F.when(F.size("_hits") > 0, F.sha2(F.array_join(wids, ","), 256)))
    sets = named.where("_set IS NOT NULL").groupBy("_set").agg(F.first(wids).alias("wids"))
    sets = sets.select("_set", F.explode("wids").alias("wid")).join(links, "wid")
    sets = sets.groupBy("_set").agg(F.array_sort(F.collect_set("item")).alias("_items"))
    sets, size = materialize(sets, "items", {"bytes": F.sum(F.size("_items").cast("bigint") * 40 + 128)})
    # rows without hits meet no set, each under a name of its own, so that they do not gather in one task
    named = named.withColumn("_set", F.coalesce("_set", F.monotonically_increasing_id().cast("string")))
    named = named.join(maybe_broadcast(sets, size["bytes"] or 0, BROADCAST_BYTES), "_set", "left").drop("_set")
    return named.withColumn("_items", F.coalesce("_items", F.array().cast(sets.schema["_items"].dataType)))


def n_hit(hits: Column) -> Column:
    """Words inside any occurrence."""
    spans = F.transform(hits, lambda h: F.sequence(h["start"], h["start"] + h["n"] - 1))
    return F.size(F.array_distinct(F.flatten(spans))).cast("bigint")


def is_contaminated(n_words: Column, hit: Column) -> Column:
    return (hit > 0) & (hit * 20 >= n_words)
