"""Exact top-k inner products by Fagin's threshold algorithm.

The vectors are dealt into shards of at most ``SHARD`` rows. Within a shard
every dimension has a list of the vectors sorted by that component. For a
query, the lists are read in step from the end that its component prefers,
each vector met for the first time is scored in full, and reading stops as
soon as the sum of the next unread components, the most that an unread vector
could score, is below the kth score found. The shards' results meet in a
top-k per query, which is pruned before the shuffle.

The shards and their lists are built and written once. Queries are a stated
set; they are packed into blocks and sent to the shards where those lie, some
``ROUND`` bytes at a time, so vectors are shuffled once, whatever the number of
queries. The kth score is shared: a first search over ``FIRST`` shards gives
every query a bound to start from, and a task carries its queries' bounds from
shard to shard, so later shards are read only down to the best bound known.
Equal vectors of a shard are kept as one vector with its ``2 * k`` smallest
ids, at most ``k`` times the same one, so that k ids that are not the query's
own remain if there are as many.

Defined results
  * Vectors that are NULL or hold a NULL or non-finite component take no part.
  * Scores need vectors of equal length; others are not compared.
  * Equal scores go by the smaller id. Rows with a NULL id take no part;
    a repeated row is a candidate of its own, but never for its own id.
  * Fewer than k candidates: all of them; an empty table: an empty result.
  * Components so large that a sum could leave 53 bits are scored in whole
    numbers; a score outside 64 bits is set to the nearest 64-bit number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize

SHARD, BLOCK, K = 8192, 512, 5
FIRST_STEP = 16  # entries of each list that are read first; each further step reads three times as many
FIRST = 2  # shards that the first search reads
ROUND = 64 << 20  # bytes of queries that are sent to the shards at a time
LARGEST = 1e300  # components are drawn in to this size, so that scaling keeps them finite
PACKED = "dim int, ids binary, data binary"
BUILT = "shard long, dim int, ids binary, copies binary, vectors binary, lists binary"
FOUND = "block long, at int, query_id long, vec_id long, score long"


def usable(vector: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.exists(vector, bad)


def _packed(size: int, scale: float):
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple[list, list]] = {}

        def out(dim: int) -> pd.DataFrame:
            ids, vectors = held.pop(dim)
            data = np.clip(np.array(vectors, dtype=np.float64), -LARGEST, LARGEST)
            return pd.DataFrame({"dim": [dim], "ids": [np.array(ids, dtype=np.int64).tobytes()],
                                 "data": [np.floor(scale * data).tobytes()]})
        for batch in batches:
            for i, v in zip(batch["id"].tolist(), batch["v"].tolist()):
                ids, vectors = held.setdefault(len(v), ([], []))
                ids.append(i)
                vectors.append(v)
                if len(ids) >= size:
                    yield out(len(v))
        for dim in list(held):
            yield out(dim)
    return pack


def packed(rows: DataFrame, size: int, scale: float) -> DataFrame:
    """``id, v`` rows in matrices of at most ``size`` rows of one length, with
    ``floor(scale * x)`` for each component."""
    return rows.mapInPandas(_packed(size, scale), PACKED)


def _first_ids(ids: np.ndarray, k: int) -> np.ndarray:
    """The first ``2 * k`` of ascending ids, at most ``k`` times the same one."""
    if len(ids) <= k + 1:
        return ids
    return ids[np.arange(len(ids)) - np.searchsorted(ids, ids) < k][:2 * k]


class Shard:
    """Sorted lists of one shard."""

    def __init__(self, ids: np.ndarray, data: np.ndarray, k: int):
        order = np.argsort(ids, kind="stable")
        data, ids = data[order], ids[order]
        vectors, where = np.unique(data, axis=0, return_inverse=True)
        by = np.argsort(where.ravel(), kind="stable")  # ids of equal vectors, ascending
        starts = np.searchsorted(where.ravel()[by], np.arange(len(vectors) + 1))
        own = [_first_ids(ids[by[a:b]], k) for a, b in zip(starts, starts[1:])]
        self._hold(own, vectors, np.argsort(vectors, axis=0, kind="stable").T.astype(np.int32))

    def _hold(self, ids: list[np.ndarray], vectors: np.ndarray, lists: np.ndarray) -> None:
        self.ids, self.vectors, self.lists = ids, vectors, lists  # lists: ascending, per dimension
        self.sorted = np.take_along_axis(vectors.T, lists, axis=1)
        self.largest = np.abs(vectors).max(initial=0)

    def stored(self) -> tuple[bytes, bytes, bytes, bytes]:
        copies = np.array([len(i) for i in self.ids], dtype=np.int32)
        return np.concatenate(self.ids).tobytes(), copies.tobytes(), self.vectors.tobytes(), self.lists.tobytes()

    @classmethod
    def read(cls, dim: int, ids: bytes, copies: bytes, vectors: bytes, lists: bytes) -> Shard:
        ends = np.cumsum(np.frombuffer(copies, dtype=np.int32))
        shard = cls.__new__(cls)
        shard._hold(np.split(np.frombuffer(ids, dtype=np.int64), ends[:-1]), np.frombuffer(vectors, dtype=np.float64).reshape(len(ends), dim),
                    np.frombuffer(lists, dtype=np.int32).reshape(dim, len(ends)))
        return shard

    def scores(self, rows: np.ndarray, q: np.ndarray) -> np.ndarray:
        if np.abs(q).max(initial=0) * self.largest * len(q) < 2 ** 53:  # floating point is exact
            return (self.vectors[rows] @ q).astype(np.int64)
        whole = [sum(int(a) * int(b) for a, b in zip(v, q)) for v in self.vectors[rows]]
        return np.array([max(-2 ** 63, min(2 ** 63 - 1, s)) for s in whole], dtype=np.int64)

    def top(self, query: int, q: np.ndarray, k: int, least: float = -np.inf) -> tuple[list[tuple[int, int]], int]:
        """``(score, id)`` of the k best that score ``least`` or more, and how
        many vectors were scored."""
        n = len(self.vectors)
        dims = np.flatnonzero(q)
        lists, values = self.lists[dims], self.sorted[dims]
        down = q[dims] > 0
        seen = np.zeros(n, dtype=bool)
        best: list[tuple[int, int]] = []
        depth, step = 0, FIRST_STEP
        while not seen.all():
            bound = max(least, -best[-1][0]) if len(best) == k else least
            ahead = np.where(down, values[:, n - 1 - depth], values[:, depth])
            if sum(int(a) * int(b) for a, b in zip(ahead, q[dims])) < bound:
                break
            to = min(n, depth + step) if len(dims) else n
            new = np.zeros(n, dtype=bool)
            new[lists[~down, depth:to]] = True
            new[lists[down, n - to:n - depth]] = True
            new = ~seen if to == n else new & ~seen
            seen |= new
            rows = np.flatnonzero(new)
            s = self.scores(rows, q)
            floor = np.partition(s, -(k + 1))[-(k + 1)] if len(s) > k + 1 else s.min(initial=0)  # one may be the query
            for r in np.flatnonzero(s >= max(floor, bound)).tolist():
                best += [(-int(s[r]), i) for i in self.ids[rows[r]].tolist() if i != query]
            best = sorted(best)[:k]
            depth, step = to, 3 * step
        return [(-v, i) for v, i in best], int(seen.sum())


def _built(k: int):
    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                ids = np.frombuffer(r.ids, dtype=np.int64)
                shard = Shard(ids, np.frombuffer(r.data, dtype=np.float64).reshape(len(ids), r.dim), k)
                yield pd.DataFrame([(r.shard, r.dim, *shard.stored())], columns=["shard", "dim", "ids", "copies", "vectors", "lists"])
    return build


def shards(rows: DataFrame, scale: float, size: int = SHARD, k: int = K) -> DataFrame:
    """``id, v`` rows as shards with their sorted lists, written once. Packs are
    dealt to tasks by their own numbers, so no id or vector makes a hot task."""
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packs = packed(rows, size, scale).withColumn("shard", F.monotonically_increasing_id())
    return materialize(packs.repartition(tasks, "shard").mapInPandas(_built(k), BUILT), "topk-shards")


class Asked:
    """Queries of one block with their best rows so far, kept while a task goes
    through its shards."""

    def __init__(self, dim: int, ids: bytes, data: bytes, known, k: int):
        self.ids, self.k = np.frombuffer(ids, dtype=np.int64).tolist(), k
        self.data = np.frombuffer(data, dtype=np.float64).reshape(len(self.ids), dim)
        self.least: list[float] = [-np.inf] * len(self.ids)
        self.best: list[list[tuple[int, int]]] = [[] for _ in self.ids]
        for e in known if known is not None else ():
            self.least[e["at"]] = int(e["score"])

    def meet(self, shard: Shard) -> None:
        for at, (query, q) in enumerate(zip(self.ids, self.data)):
            found, _ = shard.top(query, q, self.k, self.least[at])
            if found:
                best = sorted(self.best[at] + [(-s, i) for s, i in found])[:self.k]
                self.best[at] = best
                if len(best) == self.k:
                    self.least[at] = max(self.least[at], -best[-1][0])


def _searched(k: int):
    """Tasks: every shard of the task meets every block; the k best per query are handed on."""
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asked: dict[int, Asked] = {}
        last, shard = None, None
        for batch in batches:
            for r in batch.itertuples(index=False):
                if last != r.shard:
                    last, shard = r.shard, Shard.read(r.dim, r.ids, r.copies, r.vectors, r.lists)
                if r.block not in asked:
                    asked[r.block] = Asked(r.dim, r.qids, r.qdata, r.known, k)
                asked[r.block].meet(shard)
        for block, a in asked.items():
            rows = [(block, at, query, i, -s) for at, (query, best) in enumerate(zip(a.ids, a.best)) for s, i in best]
            yield pd.DataFrame(rows, columns=["block", "at", "query_id", "vec_id", "score"]).astype("int64").astype({"at": "int32"})
    return search


def _search(held: DataFrame, asked: DataFrame, rounds: int, k: int) -> DataFrame:
    """The k best rows that each task finds per query. ``asked`` is sent to the
    shards in ``rounds`` parts, each of bounded size."""
    found = None
    for r in range(rounds):
        met = held.join(F.broadcast(asked.where(F.col("round") == r)), "dim")
        met = met.select("shard", "dim", "ids", "copies", "vectors", "lists", "block", "qids", "qdata", "known")
        part = met.mapInPandas(_searched(k), FOUND)
        if rounds > 1:  # one part is sent at a time
            part = materialize(part, "topk-round")
        found = part if found is None else found.unionByName(part)
    return found


def top_k(rows: DataFrame, is_query: Column, k: int = K, vec: str = "vec_id", vector: str = "embedding",
          scale: float = 256, shard: int = SHARD, block: int = BLOCK, sent: int = ROUND) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows that ``is_query`` picks,
    against all rows."""
    rows = rows.where(F.col(vec).isNotNull() & usable(F.col(vector)))
    flat = lambda df: df.select(F.col(vec).cast("bigint").alias("id"), F.col(vector).alias("v"))
    held = shards(flat(rows), scale, shard, k)
    asked = packed(flat(rows.where(is_query)), block, scale).select(
        F.monotonically_increasing_id().alias("block"), "dim", F.col("ids").alias("qids"), F.col("data").alias("qdata"))
    asked, seen = materialize(asked, "topk-queries", {"bytes": F.sum(F.octet_length("qdata") + F.octet_length("qids"))})
    rounds = 1 + (seen["bytes"] or 0) // sent
    asked = asked.withColumn("round", F.pmod(F.xxhash64("block"), F.lit(rounds)))

    chosen = [r["shard"] for r in held.select("shard").orderBy("shard").limit(FIRST).collect()]
    first = F.col("shard").isin(chosen) if chosen else F.lit(False)
    nothing = F.lit(None).cast("array<struct<at:int,score:bigint>>")
    start = _search(held.where(first), asked.withColumn("known", nothing), rounds, k)
    order = Window.partitionBy("block", "at").orderBy(F.desc("score"), "vec_id")
    start = materialize(start.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "topk-first")
    known = start.where(F.col("rank") == k).groupBy("block").agg(F.collect_list(F.struct("at", "score")).alias("known"))  # at most ``block`` entries
    rest = _search(held.where(~first), asked.join(known, "block", "left"), rounds, k)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = start.drop("rank").unionByName(rest).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
