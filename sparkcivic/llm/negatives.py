"""Hard negatives by inner-product search with length and coordinate bounds.

An anchor's positives are its best rows of the same label. Its negatives for
one positive are the best rows of other labels whose score lies in a band below
the positive's score. Both are searches for all rows that reach a bound, in the
manner of LEMP:

* Rows are sorted by length over the whole cluster and cut into buckets of at
  most ``BUCKET`` rows whose lengths differ little (:func:`buckets`). Each
  bucket holds, per coordinate, the sorted list of its rows' directions. The
  buckets are written once; every search reads them where they lie.
* Anchors are a stated set. They are packed into blocks, and up to ``ROUND``
  anchors at a time (a proven bound in bytes) are sent to the buckets, so the
  buckets are never copied and what is shuffled grows with the results.
* An anchor with bound b asks of a bucket whose longest row has length l that
  the cosine reaches c = b / (anchor length * l). If c > 1, the bucket holds
  nothing for it. Else a row that reaches c has, in each coordinate where the
  direction of the anchor is cos a, a value from cos(a + acos c) to cos(a - acos c).
  These ranges are cut from the sorted lists of the ``FOCUS`` coordinates in
  which the anchor is largest; the rows within all of them are the candidates,
  which are then scored in full.
* The bound of a positives search is the fifth best score so far. A first
  search over a few buckets of the longest rows gives every anchor a bound to
  start from, and a task carries its bounds from bucket to bucket. The bound of
  a negatives search is known: the lower end of the band, later the fifth
  best score within it.

Defined results
  * Rows with a NULL id, label or vector, or with a NULL or non-finite
    component, take no part; nor do vectors of another length than the anchor's.
  * Equal scores go by the smaller id. A repeated row is a row of its own, but
    never for an anchor of its own id; a repeated anchor is answered each time.
  * A band below a negative positive score is empty.
  * Fewer rows than asked for: all of them. No anchors, or an empty table: an
    empty result.
  * Scores that could leave 53 bits are computed in whole numbers, and set to
    the nearest 64-bit number.
  * Only the id, label and vector columns are read, so others cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .topk import LARGEST, usable

BUCKET, BLOCK = 4096, 512  # rows of a bucket, anchors of a block
ROUND = 64 << 20  # bytes of anchors that are sent to the buckets at a time
NEAR, FEWEST = 0.9, 256  # a bucket ends where lengths fall below NEAR of its longest, if it has FEWEST rows
FOCUS = 3
LONGEST = 8  # buckets that the first search reads
POSITIVES, NEGATIVES = 5, 5
BAND = (4, 5)  # a negative scores at least 4/5 of the positive
SLACK, MARGIN = 1e-9, 1e-6  # of cosines and of the ranges, far above rounding
PACKED = "dim int, longest double, ids binary, labels binary, data binary"
FOUND = "block long, at int, slot int, asked long, id long, score long"


def lengths(data: np.ndarray) -> np.ndarray:
    top = np.abs(data).max(axis=1, initial=0)
    unit = data / np.where(top > 0, top, 1)[:, None]
    return top * np.sqrt((unit * unit).sum(axis=1))


def _packed(size: int, scale: float, near: float):
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []

        def out() -> pd.DataFrame:
            ids, labels, vectors = zip(*held)
            data = np.floor(scale * np.clip(np.array(vectors, dtype=np.float64), -LARGEST, LARGEST))
            held.clear()
            return pd.DataFrame({"dim": [data.shape[1]], "longest": [lengths(data).max(initial=0)], "ids": [np.array(ids, dtype=np.int64).tobytes()],
                                 "labels": [np.array(labels, dtype=np.int64).tobytes()], "data": [data.tobytes()]})
        first = 0.0
        for batch in batches:
            for i, label, length, v in zip(batch["id"].tolist(), batch["label"].tolist(), batch["length"].tolist(), batch["v"]):
                if held and (len(held) >= size or len(held[0][2]) != len(v) or len(held) >= FEWEST and length < near * first):
                    yield out()
                first = first if held else length
                held.append((i, label, v))
        if held:
            yield out()
    return pack


def buckets(rows: DataFrame, scale: float, size: int = BUCKET) -> DataFrame:
    """``id, label, v`` rows in matrices of at most ``size`` rows of like length."""
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    rows = rows.withColumn("dim", F.size("v")).withColumn("length", F.sqrt(squares)).withColumn("part", F.xxhash64("id"))
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["dim", F.desc("length"), "part"]  # the hash divides a length that many rows share
    rows = rows.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    return rows.select("id", "label", "length", "v").mapInPandas(_packed(size, scale, NEAR), PACKED)


class Bucket:
    """Rows of like length, with sorted lists of the coordinates of their directions."""

    def __init__(self, dim: int, ids: bytes, labels: bytes, data: bytes):
        self.ids, self.labels = np.frombuffer(ids, dtype=np.int64), np.frombuffer(labels, dtype=np.int64)
        self.data = np.frombuffer(data, dtype=np.float64).reshape(len(self.ids), dim)
        length = lengths(self.data)
        self.longest = length.max(initial=0)
        self.directions = self.data / np.where(length > 0, length, 1)[:, None]
        self.largest = np.abs(self.data).max(initial=0)
        self._lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def list_of(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self._lists:
            order = np.argsort(self.directions[:, f], kind="stable")
            self._lists[f] = order, self.directions[order, f]
        return self._lists[f]

    def candidates(self, direction: np.ndarray, length: float, bound: float) -> np.ndarray | None:
        """Places of all rows that can reach ``bound``; None: all rows."""
        if bound == -np.inf:
            return None
        with np.errstate(all="ignore"):
            c = bound / (length * self.longest)
        if bound > 0 and c > 1 + SLACK:
            return np.zeros(0, dtype=np.int64)
        if not c > 0:  # nothing is known; also where the product of the lengths is beyond floating point
            return None
        wide, met, parts = np.arccos(min(c, 1.0) - SLACK), None, 0
        for f in np.argsort(-np.abs(direction), kind="stable")[:FOCUS]:
            at = np.arccos(np.clip(direction[f], -1, 1))
            lo, hi = np.cos(min(np.pi, at + wide)), np.cos(max(0.0, at - wide))
            order, values = self.list_of(int(f))
            i, j = np.searchsorted(values, lo - MARGIN, "left"), np.searchsorted(values, hi + MARGIN, "right")
            if j - i == len(values):
                continue
            parts += 1
            if met is None:
                met = np.zeros(len(values), dtype=np.int8)
            met[order[i:j]] += 1
        return None if met is None else np.flatnonzero(met == parts)

    def scores(self, places: np.ndarray | None, q: np.ndarray) -> np.ndarray:
        data = self.data if places is None else self.data[places]
        if np.abs(q).max(initial=0) * self.largest * max(1, len(q)) < 2 ** 53:  # floating point is exact
            return (data @ q).astype(np.int64)
        whole = [sum(int(a) * int(b) for a, b in zip(v, q)) for v in data]
        return np.array([max(-2 ** 63, min(2 ** 63 - 1, s)) for s in whole], dtype=np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids."""
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], ~scores[at]))][:k]


class Slot:
    """The k best of one search so far, within ``floor`` to ``ceiling``."""

    def __init__(self, k: int, floor: float, ceiling: float):
        self.k, self.floor, self.ceiling, self.ids, self.scores = k, floor, ceiling, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def bound(self) -> float:
        return max(self.floor, self.scores[-1]) if len(self.scores) == self.k else self.floor

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        fit = scores >= self.bound()  # whole numbers against a whole bound
        if self.ceiling < np.inf:
            fit &= scores <= self.ceiling
        if fit.any():
            ids, scores = np.concatenate([self.ids, ids[fit]]), np.concatenate([self.scores, scores[fit]])
            keep = best(scores, ids, self.k)
            self.ids, self.scores = ids[keep], scores[keep]


class Asked:
    """Anchors of one block with their searches, kept while a task goes through its buckets."""

    def __init__(self, dim: int, ids: bytes, labels: bytes, data: bytes, slots: list[list[Slot]], same: bool):
        self.ids, self.labels, self.same, self.slots = np.frombuffer(ids, dtype=np.int64), np.frombuffer(labels, dtype=np.int64), same, slots
        self.data = np.frombuffer(data, dtype=np.float64).reshape(len(self.ids), dim)
        self.lengths = lengths(self.data)
        self.directions = self.data / np.where(self.lengths > 0, self.lengths, 1)[:, None]
        self.scored = 0

    def meet(self, bucket: Bucket) -> None:
        for at, slots in enumerate(self.slots):
            if not slots:
                continue
            places = bucket.candidates(self.directions[at], self.lengths[at], min(s.bound() for s in slots))
            if places is not None and not len(places):
                continue
            ids, labels = (bucket.ids, bucket.labels) if places is None else (bucket.ids[places], bucket.labels[places])
            fit = (labels == self.labels[at]) == self.same
            fit &= ids != self.ids[at]
            if fit.mean() < 0.5:  # labels first where they leave few rows to score
                keep = np.flatnonzero(fit)
                places = keep if places is None else places[keep]
                ids, fit = ids[keep], np.ones(len(keep), dtype=bool)
            scores = bucket.scores(places, self.data[at])
            self.scored += len(scores)
            fit &= scores >= min(s.bound() for s in slots)
            ids, scores = ids[fit], scores[fit]
            for slot in slots if len(ids) else ():
                slot.add(ids, scores)


def _floor(score: int) -> int:
    return -(-BAND[0] * score // BAND[1])


def _searched(same: bool, k: int):
    """Tasks: every bucket of the task meets every block; per search the k best are handed on."""
    def slots_of(n: int, known) -> list[list[Slot]]:
        if same:
            lows = {} if known is None else {e["at"]: e["score"] for e in known}
            return [[Slot(k, lows.get(at, -np.inf), np.inf)] for at in range(n)]
        slots: list[list[Slot]] = [[] for _ in range(n)]
        for e in sorted(known, key=lambda e: e["slot"]):
            slots[e["at"]].append(Slot(k, _floor(e["score"]), e["score"]) if e["score"] >= 0 else Slot(k, np.inf, np.inf))
        return slots

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked: dict[int, Asked] = {}
        last, bucket = None, None
        for batch in batches:
            for r in batch.itertuples(index=False):
                if last != r.bucket:
                    last, bucket = r.bucket, Bucket(r.dim, r.ids, r.labels, r.data)
                if r.block not in asked:
                    n = len(r.qids) // 8
                    asked[r.block] = Asked(r.dim, r.qids, r.qlabels, r.qdata, slots_of(n, r.known), same)
                asked[r.block].meet(bucket)
        for block, a in asked.items():
            rows = [(block, at, slot, int(a.ids[at]), i, s) for at, slots in enumerate(a.slots) for slot, x in enumerate(slots)
                    for i, s in zip(x.ids.tolist(), x.scores.tolist())]
            yield pd.DataFrame(rows, columns=["block", "at", "slot", "asked", "id", "score"]).astype({"at": "int32", "slot": "int32"})
    return search


def _search(held: DataFrame, asked: DataFrame, rounds: int, same: bool, k: int) -> DataFrame:
    """The k best rows per search, ``rank`` from 1. ``asked`` is sent to the
    buckets in ``rounds`` parts, each of bounded size."""
    found = None
    for r in range(rounds):
        now = asked.where(F.col("round") == r)
        met = held.join(F.broadcast(now), "dim").select("bucket", "dim", "ids", "labels", "data", "block", "qids", "qlabels", "qdata", "known")
        part = met.mapInPandas(_searched(same, k), FOUND)
        if rounds > 1:  # one part is sent at a time
            part = materialize(part, "negatives-round")
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("block", "at", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _with_known(asked: DataFrame, known: DataFrame, how: str) -> DataFrame:
    """What is known of a block's searches, as a list beside the block (at
    most BLOCK times POSITIVES entries)."""
    lists = known.groupBy("block").agg(F.collect_list(F.struct("at", "slot", "score")).alias("known"))
    return asked.drop("known").join(lists, "block", how)


def hard_negatives(rows: DataFrame, is_anchor: Column, vec: str = "vec_id", vector: str = "embedding", label: str | Column = "label",
                   scale: float = 256, positives: int = POSITIVES, negatives: int = NEGATIVES, bucket: int = BUCKET, block: int = BLOCK,
                   sent: int = ROUND) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score`` for the anchors that ``is_anchor`` picks, against all rows."""
    label = F.col(label) if isinstance(label, str) else label
    rows = rows.where(F.col(vec).isNotNull() & label.isNotNull() & usable(F.col(vector)))
    flat = lambda df: df.select(F.col(vec).cast("bigint").alias("id"), label.cast("bigint").alias("label"), F.col(vector).cast("array<double>").alias("v"))
    held = materialize(buckets(flat(rows), scale, bucket).withColumn("bucket", F.monotonically_increasing_id()), "negatives-buckets")
    asked = flat(rows.where(is_anchor)).withColumn("dim", F.size("v")).withColumn("length", F.lit(0.0))
    asked = asked.repartition("dim", F.pmod(F.xxhash64("id"), F.lit(256))).sortWithinPartitions("dim", "id")
    asked = asked.select("id", "label", "length", "v").mapInPandas(_packed(block, scale, 0.0), PACKED).select(
        F.monotonically_increasing_id().alias("block"), "dim", F.col("ids").alias("qids"), F.col("labels").alias("qlabels"), F.col("data").alias("qdata"))
    asked, seen = materialize(asked, "negatives-anchors", {"bytes": F.sum(F.octet_length("qdata"))})
    rounds = 1 + (seen["bytes"] or 0) // sent
    asked = asked.withColumn("round", F.pmod(F.xxhash64("block"), F.lit(rounds)))
    nothing = F.lit(None).cast("array<struct<at:int,slot:int,score:bigint>>")

    longest = [r["bucket"] for r in held.select("bucket", "longest").orderBy(F.desc("longest"), "bucket").limit(LONGEST).collect()]
    first = F.col("bucket").isin(longest) if longest else F.lit(False)
    start = materialize(_search(held.where(first), asked.withColumn("known", nothing), rounds, True, positives), "negatives-first")
    bounds = start.where(F.col("rank") == positives)
    rest = _search(held.where(~first), _with_known(asked, bounds, "left"), rounds, True, positives).drop("rank")
    order = Window.partitionBy("block", "at").orderBy(F.desc("score"), "id")
    near = start.drop("rank").unionByName(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= positives)
    near = materialize(near.select("block", "at", (F.col("rank") - 1).alias("slot"), "id", "score"), "negatives-positives")

    found = _search(held, _with_known(asked, near, "inner"), rounds, False, negatives)
    on = ["block", "at", "slot"]
    near = near.select(*on, F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(near, on).select(F.col("asked").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"),
                                       F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
