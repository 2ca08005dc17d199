"""N-gram Jaccard join: blocked sparse product of the document by n-gram matrix.

Two documents link when the Jaccard similarity of their sets of n-grams is at
least ``SIMILAR`` (a fraction, so that all bounds are whole numbers). The
links' components are returned, with no link between different texts lost:

1. ``summaries``: per document the size of its set and a 128-bit digest of it,
   and a histogram of all n-grams over a fixed number of buckets.
2. ``classes``: documents with the same set become one row of the matrix. The
   n-grams of a row are ordered rarest first (histogram, then hash); only a
   row's first ``n - ceil(t n) + 1`` entries enter the product, as two sets
   that link must share one of them.
3. Near copies are contracted: rows that agree in a band of min-hashes are
   checked against the row of that band whose n-grams are the commonest, the
   likely original, and checked links make groups.
4. ``live_entries`` deals the entries into column blocks by n-gram hash and
   drops the columns that hold rows of one group only. What a row loses there
   no row of another group has, which bounds its overlap with any of them.
   ``overlaps`` is the product of what is left: within a block equal n-grams
   meet: a row looks only at those partners whose sizes leave its bound
   sufficient, and a row whose bound suffices for none is never paired from its
   side. Pairs of one group are left out, and the overlaps are added up over
   the blocks. Pairs below the
   overlap that their sizes demand are discarded. A block's pairs are made row
   by row, ``PAIRS`` at a time, and counted and written before the next ones are
   made, so they need not fit a task together. A column that is expected to
   exceed ``COLUMN`` rows is cut into tiles of row blocks, so that no task
   holds all of it.
5. ``verified``: the exact overlap of the sets of the pairs that are left.

N-grams are 64-bit hashes. Histogram and row count are all that reaches the
driver; pair tables are broadcast only if their counted rows are within
``BROADCAST_ROWS``, and joined by shuffle otherwise.

Defined results
  * Words are what blanks (space, tab to carriage return) separate, A-Z in
    lower case. Fewer words than the width: the whole sequence is one n-gram.
  * NULL text, empty text and text without words: size 0, linked with
    nothing; the component is the document itself.
  * Every row gives one row. Repeated rows have equal ids and equal sets and
    so share a component; rows of one id with different texts are each
    compared. A NULL id takes no part: its component is NULL.
  * An empty table gives an empty result. Only the id and text columns are
    read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import id_text, maybe_broadcast, whole_ids
from .components import components

WIDTH = 5
SIMILAR = (4, 5)  # least similarity as a fraction
BUCKET_BITS, HISTOGRAM_PARTS = 20, 128
BANDS, BAND_ROWS = 4, 2
BLOCK = 500_000  # entries that one column block is made for
COLUMN = 500_000  # rows of one column that one tile holds
PAIRS = 200_000  # pairs that a task looks at in one go, and rows that it writes at a time
FLUSH, FRAMES = 500_000, 16  # entries that a dealing task gathers before it writes, frames that it writes them in
BROADCAST_ROWS = 200_000
RUN_CHARS, SLICE_BYTES = 1_000_000, 4_000_000

_U = np.uint64
_BYTES = np.random.default_rng(20250101).integers(1, 2 ** 63, 256, dtype=np.uint64) | _U(1)  # a fixed value per byte
_PLACES = np.random.default_rng(20250102).integers(1, 2 ** 63, 64, dtype=np.uint64) | _U(1)  # odd factors
_BASE = _U(0x9E3779B97F4A7C15)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and starting place of each word."""
    raw = np.frombuffer(data, dtype=np.uint8)
    blank = _BLANK[raw]
    edge = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), starts
    size = ends - starts
    first = np.cumsum(size) - size
    at = np.arange(int(size.sum())) - np.repeat(first, size)
    power = np.full(int(size.max()), _BASE)
    power[0] = 1
    power = np.multiply.accumulate(power)
    return mix(np.add.reduceat(_BYTES[raw[~blank]] * power[at], first) ^ size.astype(np.uint64)), starts


def _slices(data: bytes) -> Iterator[tuple[int, bytes]]:
    """Parts of about ``SLICE_BYTES``, cut at a blank."""
    a = 0
    while a < len(data):
        b = a + SLICE_BYTES
        while b < len(data) and not _BLANK[data[b]]:
            b += 1
        yield a, data[a:b]
        a = b


def ngram_sets(texts: list[str], width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of each text."""
    parts = [t.encode("utf-8", "replace").lower() for t in texts]
    limits = np.cumsum([0, *(len(p) + 1 for p in parts)])
    found = [(h, s + a) for a, x in _slices(b"\n".join(parts)) for h, s in [_word_hashes(x)]]
    words = np.concatenate([h for h, _ in found]) if found else np.zeros(0, dtype=np.uint64)
    at = np.searchsorted(np.concatenate([s for _, s in found]) if found else np.zeros(0), limits)
    grams = np.zeros(max(0, len(words) - width + 1), dtype=np.uint64)
    for j in range(width if len(grams) else 0):
        grams += words[j:j + len(grams)] * _PLACES[j]
    grams = mix(grams)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(grams[a:b - width + 1]))
        else:  # the number of words sets it apart from n-grams of full width
            short = (words[a:b] * _PLACES[:b - a]).sum(dtype=np.uint64, keepdims=True) + _PLACES[-1 - (b - a):][:1]
            out.append(mix(short) if b > a else np.zeros(0, dtype=np.uint64))
    return out


def _digest(s: np.ndarray, seed: int) -> int:
    return int(mix(s ^ _PLACES[40 + seed]).sum(dtype=np.uint64).astype(np.int64))


def _runs(batch: pd.DataFrame) -> Iterator[tuple[list, list[np.ndarray]]]:
    ids, texts = whole_ids(batch["id"]), [t or "" for t in batch["text"].tolist()]
    a = n = 0
    for i, t in enumerate(texts):
        n += len(t)
        if n >= RUN_CHARS or i + 1 == len(texts):
            yield ids[a:i + 1], ngram_sets(texts[a:i + 1])
            a, n = i + 1, 0


def _summarised(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts = np.zeros(1 << BUCKET_BITS, dtype=np.int64)
    for batch in batches:
        for ids, sets in _runs(batch):
            counts += np.bincount((np.concatenate(sets) >> _U(64 - BUCKET_BITS)).astype(np.int64), minlength=len(counts))
            yield pd.DataFrame({"id": pd.array(ids, dtype="Int64"), "n": [len(s) for s in sets], "d1": [_digest(s, 1) for s in sets],
                                "d2": [_digest(s, 2) for s in sets], "part": None, "task": None, "counts": None})
    if counts.any():
        for k, c in enumerate(np.split(np.minimum(counts, 2 ** 31 - 1).astype(np.int32), HISTOGRAM_PARTS)):
            yield pd.DataFrame({"id": None, "n": None, "d1": None, "d2": None, "part": [k],
                                "task": [TaskContext.get().partitionId()], "counts": [c.tobytes()]})


def _added(g: pd.DataFrame) -> pd.DataFrame:
    total = np.sum([np.frombuffer(c, dtype=np.int32) for c in g["counts"]], axis=0, dtype=np.int64)
    return pd.DataFrame({"part": g["part"].iloc[:1], "task": g["task"].iloc[:1] // 256,
                         "counts": [np.minimum(total, 2 ** 31 - 1).astype(np.int32).tobytes()]})


def summaries(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """``id, n, d1, d2`` of every row (a written table) and the histogram."""
    rows = docs.select(id_text(F.col("id")).alias("id"), "text").mapInPandas(_summarised, "id long, n long, d1 long, d2 long, part int, task int, counts binary")
    rows = materialize(rows, "summaries")
    parts = rows.where("part is not null").select("part", "task", "counts")
    for _ in range(2):  # 256 tasks at a time, then what they gave
        parts = parts.groupBy("part", F.floor(F.col("task") / 256).alias("by")).applyInPandas(_added, "part int, task int, counts binary")
    got = parts.groupBy("part").applyInPandas(_added, "part int, task int, counts binary").toPandas()
    counts = np.zeros((HISTOGRAM_PARTS, (1 << BUCKET_BITS) // HISTOGRAM_PARTS), dtype=np.int32)
    for k, c in zip(got["part"], got["counts"]):
        counts[k] = np.frombuffer(c, dtype=np.int32)
    return rows.where("part is null").select("id", "n", "d1", "d2"), counts.ravel()


def _prefix_length(n):
    up, down = SIMILAR
    return n - -(-n * up // down) + 1


def classes(docs: DataFrame, counts) -> DataFrame:
    """One row per distinct set: ``id`` (least document), ``n, d1, d2``,
    ``prefix`` (its rarest n-grams), ``last_count, last_gram`` (where its prefix
    ends in the order), ``common`` (how common its n-grams are on average) and
    ``bands`` (keys of min-hash bands)."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rare = counts.value
        for batch in batches:
            for ids, sets in _runs(batch):
                kept = [(i, s) for i, s in zip(ids, sets) if len(s) and i is not None]
                if not kept:
                    continue
                ids, sets = [i for i, _ in kept], [s for _, s in kept]
                flat, size = np.concatenate(sets), np.array([len(s) for s in sets])
                first = np.cumsum(size) - size
                least = [np.minimum.reduceat(mix(flat ^ _PLACES[10 + j]), first) for j in range(BANDS * BAND_ROWS)]
                bands = np.stack([mix(sum((m * _PLACES[30 + r] for r, m in enumerate(least[b * BAND_ROWS:(b + 1) * BAND_ROWS])),
                                          np.full(len(sets), b, dtype=np.uint64))) for b in range(BANDS)], axis=1)
                often = [rare[(s >> _U(64 - BUCKET_BITS)).astype(np.int64)] for s in sets]
                prefix = [s[np.lexsort((s, c))[:_prefix_length(len(s))]] for s, c in zip(sets, often)]
                last = np.array([p[-1] for p in prefix], dtype=np.uint64)
                yield pd.DataFrame({"id": np.array(ids, dtype=np.int64), "n": size, "d1": [_digest(s, 1) for s in sets],
                                    "d2": [_digest(s, 2) for s in sets], "prefix": [p.tobytes() for p in prefix],
                                    "last_count": rare[(last >> _U(64 - BUCKET_BITS)).astype(np.int64)].astype(np.int64),
                                    "last_gram": (last ^ _U(1 << 63)).astype(np.int64),  # signed, in the same order
                                    "common": [float(np.log1p(c).mean()) for c in often], "bands": list(bands.astype(np.int64))})
    found = docs.select(id_text(F.col("id")).alias("id"), "text").mapInPandas(rows, "id long, n long, d1 long, d2 long, prefix binary, last_count long, last_gram long, "
                                   "common double, bands array<long>")
    same = ("prefix", "last_count", "last_gram", "common", "bands")  # equal sets have them all in common
    return found.groupBy("n", "d1", "d2").agg(F.min("id").alias("id"), *[F.first(c).alias(c) for c in same])


@F.pandas_udf(T.ArrayType(T.LongType()))
def _sets(texts: pd.Series) -> pd.Series:
    texts, out = texts.fillna("").tolist(), []
    for a in range(0, len(texts), 64):
        out += [s.astype(np.int64) for s in ngram_sets(texts[a:a + 64])]
    return pd.Series(out)


def _compatible(a: Column, b: Column) -> Column:
    """The smaller set is large enough for the larger one."""
    up, down = SIMILAR
    return F.least(a, b) * down >= F.greatest(a, b) * up


def _needed(a: Column, b: Column) -> Column:
    """Least overlap of two sets that link: ``t (a + b) / (1 + t)``, rounded up."""
    up, down = SIMILAR
    return F.ceil((a + b) * up / (up + down) - 1e-9)


def verified(pairs: DataFrame, docs: DataFrame, rows: int) -> DataFrame:
    """Those of the pairs ``a, b`` whose sets link, repeated if their documents
    are. Only texts of documents in pairs are read into sets; ``rows``: the
    counted pairs."""
    ends = pairs.select("b").distinct()
    left = docs.join(maybe_broadcast(pairs, rows, BROADCAST_ROWS), F.col("id") == F.col("a")).select("a", "b", _sets("text").alias("x"))
    right = docs.join(maybe_broadcast(ends, rows, BROADCAST_ROWS), F.col("id") == F.col("b")).select("b", _sets("text").alias("y"))
    up, down = SIMILAR
    both = left.join(right, "b").withColumn("o", F.size(F.array_intersect("x", "y")))  # a hot b may be split
    return both.where(F.col("o") * (up + down) >= (F.size("x") + F.size("y")) * up).select("a", "b")


def contracted(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Checked links ``a, b`` between rows and the commonest row of a band."""
    keys = rows.select("id", "n", "common", F.explode("bands").alias("band"))
    heads = keys.groupBy("band").agg(F.max_by(F.struct("id", "n"), F.struct("common", -F.col("id"))).alias("head"),
                                     F.count(F.lit(1)).alias("size")).where("size > 1")
    pairs = keys.join(heads, "band").where((F.col("id") != F.col("head.id")) & _compatible(F.col("n"), F.col("head.n")))
    pairs, seen = materialize(pairs.select(F.col("id").alias("a"), F.col("head.id").alias("b")).distinct(), "band-pairs",
                              {"rows": F.count(F.lit(1))})
    return verified(pairs, docs, seen["rows"])


def _blocks(entries: int) -> int:
    return max(1, -(-entries // BLOCK))


def _dealt(blocks: int, counts, column: int):
    """Entries of the matrix, packed for each column block."""
    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rare, held, n = counts.value, [], 0

        def out() -> Iterator[pd.DataFrame]:
            size = np.array([len(p) for _, _, p in held])
            ids, groups = (np.repeat(np.array([x[k] for x in held], dtype=np.int64), size) for k in range(2))
            grams = np.concatenate([p for _, _, p in held])
            held.clear()
            cuts = -(-rare[(grams >> _U(64 - BUCKET_BITS)).astype(np.int64)].astype(np.int64) // column)
            block = (grams % _U(blocks)).astype(np.int64)
            wide = cuts > 1  # a large column: its rows go to as many blocks as it has parts
            part = mix(ids[wide].astype(np.uint64)) % cuts[wide].astype(np.uint64)
            block[wide] = blocks + (mix(part ^ mix(grams[wide])) >> _U(2)).astype(np.int64)
            order = np.argsort(block, kind="stable")
            edges = np.flatnonzero(np.diff(block[order], prepend=-1)).tolist() + [len(order)]
            parts = [order[a:b] for a, b in zip(edges, edges[1:])]
            step = -(-len(parts) // FRAMES)
            for k in range(0, len(parts), step):
                some = parts[k:k + step]
                yield pd.DataFrame({"block": [int(block[w[0]]) for w in some], "grams": [grams[w].tobytes() for w in some],
                                    "ids": [ids[w].tobytes() for w in some], "groups": [groups[w].tobytes() for w in some],
                                    "cuts": [cuts[w].astype(np.int32).tobytes() for w in some]})
        for batch in batches:
            for i, g, p in zip(batch["id"].tolist(), batch["component"].tolist(), batch["prefix"].tolist()):
                held.append((i, g, np.frombuffer(p, dtype=np.uint64)))
                n += len(held[-1][2])
                if n >= FLUSH:
                    yield from out()
                    n = 0
        if held:
            yield from out()
    return deal


def _alive(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Entries of columns with rows of two groups; of parts of a large column, all."""
    kinds = {"grams": np.uint64, "ids": np.int64, "groups": np.int64, "cuts": np.int32}
    held = {k: [] for k in kinds}
    for g in batches:
        for k in kinds:
            held[k] += g[k].tolist()
    grams, ids, groups, cuts = (np.frombuffer(b"".join(held.pop(k)), dtype=t) for k, t in kinds.items())
    order = np.argsort(grams, kind="stable")
    grams, ids, groups, cuts = grams[order], ids[order], groups[order], cuts[order]
    start = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
    mixed = np.minimum.reduceat(groups, start) != np.maximum.reduceat(groups, start)
    keep = np.flatnonzero(np.repeat(mixed, np.diff(np.append(start, len(grams)))) | (cuts > 1))
    for a in range(0, len(keep), PAIRS):
        at = keep[a:a + PAIRS]
        yield pd.DataFrame({"gram": grams[at].astype(np.int64), "id": ids[at], "cut": np.maximum(cuts[at], 1)})


def live_entries(rows: DataFrame, entries: int, counts, column: int = COLUMN) -> DataFrame:
    """``gram, id, cut``: entries whose column holds rows of several groups.
    ``cut``: parts that the column is to be cut into."""
    dealt = rows.select("id", "component", "prefix").mapInPandas(
        _dealt(_blocks(entries), counts, column), "block long, grams binary, ids binary, groups binary, cuts binary")
    return dealt.groupBy("block").applyInPandas(_alive, "gram long, id long, cut int")


def product(gram, id, group, n, live, last_count, last_gram, side) -> Iterator[tuple[np.ndarray, ...]]:
    """Pairs of rows that meet in a column: ``a < b``, their sizes and a bound,
    once for each shared column. Left out: pairs of one group, of incompatible
    sizes, and those whose overlap is bounded below what they need. The bound
    is what their overlap could be if nothing of this block were shared. Last,
    the numbers of the row that looks and of the one it looks at: the same row
    of a pair looks in all columns, and the rows that look come in order."""
    up, down = SIMILAR
    order = np.lexsort((n, gram))
    gram, id, group, n, live, last_count, last_gram, side = (x[order] for x in (gram, id, group, n, live, last_count, last_gram, side))
    most = n - (_prefix_length(n) - live)  # overlap at most, with a row of another group whose prefix ends later
    order = np.lexsort((n, id, last_gram, last_count))
    new = np.zeros(len(gram), dtype=np.int32)
    for x in (n, id, last_gram, last_count):
        new[1:] |= x[order[1:]] != x[order[:-1]]
    row = np.empty(len(gram), dtype=np.int32)  # numbers of rows, by the rank of the prefix's end
    row[order] = np.cumsum(new)
    # sizes ascend within a column, so the partners whose sizes leave a row's bound sufficient are one stretch of it
    column = np.cumsum(np.concatenate([[0], gram[1:] != gram[:-1]])[:len(gram)]).astype(np.int64)
    del gram, live, last_count, last_gram, order, new
    top = int(n.max()) + 2 if len(n) else 1
    place = column * top + n
    least, largest = -(-n * up // down), np.minimum(n * down // up, most * (up + down) // up - n)
    low = np.searchsorted(place, column * top + least)
    high = np.searchsorted(place, column * top + np.clip(largest, 0, top - 1), side="right")
    del column, place, least, largest
    rest = most - np.bincount(row)[row]  # without the entries of the row in this block
    looks = np.flatnonzero(high > low)
    looks = looks[np.argsort(row[looks], kind="stable")]
    for i in _in_chunks(looks, high - low):
        width = high[i] - low[i]
        first = np.cumsum(width) - width
        j = np.arange(int(width.sum())) + np.repeat(low[i] - first, width)
        i = np.repeat(i, width)
        meet = (row[i] < row[j]) & (group[i] != group[j]) & ((side[i] == 0) | (side[i] != side[j]))
        i, j = i[meet], j[meet]
        if len(i):
            a, b = np.where(id[i] > id[j], j, i), np.where(id[i] > id[j], i, j)
            yield id[a], id[b], n[a], n[b], rest[i], row[i], row[j]


def _in_chunks(rows: np.ndarray, width: np.ndarray) -> Iterator[np.ndarray]:
    """``rows`` in stretches of about ``PAIRS`` pairs, at least one row each."""
    if len(rows):
        which = np.cumsum(width[rows]) // PAIRS
        yield from np.split(rows, np.flatnonzero(np.diff(which)) + 1)


def counted(chunks: Iterator[tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, ...]]:
    """The pairs of ``product``, each once, and the number of columns that each
    shares. Only the pairs of a chunk's last row wait for the next chunk."""
    held = None
    for chunk in chunks:
        chunk = *chunk, np.ones(len(chunk[0]), dtype=np.int64)
        if held is not None:
            chunk = [np.concatenate(x) for x in zip(held, chunk)]
        *pair, looks, at, o = chunk
        order = np.lexsort((at, looks))
        looks, at = looks[order], at[order]
        first = np.flatnonzero(np.concatenate([[True], (looks[1:] != looks[:-1]) | (at[1:] != at[:-1])]))
        once = [*(x[order[first]] for x in pair), looks[first], at[first], np.add.reduceat(o[order], first)]
        whole = np.searchsorted(once[-3], once[-3][-1])
        held = [x[whole:] for x in once]
        yield *(x[:whole] for x in once[:-3]), once[-1][:whole]
    if held is not None:
        yield *held[:-3], held[-1]


#: Columns of a tile's entries, in types that hold them
MET = {"gram": np.int64, "id": np.int64, "component": np.int64, "n": np.int64, "live": np.int32, "last_count": np.int32,
       "last_gram": np.int64, "side": np.int8}


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    held = {c: [] for c in MET}
    for g in batches:
        for c, t in MET.items():
            held[c].append(g.column(c).to_numpy().astype(t))  # a copy, as a view holds all columns
    for c in MET:
        yield np.concatenate(held.pop(c))


def _multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    up, down = SIMILAR
    for a, b, na, nb, rest, o in counted(product(*_entries(batches))):
        keep = rest + o >= -(-(na + nb) * up // (up + down))  # what this block did not share is lost
        yield pa.RecordBatch.from_pydict({"a": a[keep], "b": b[keep], "na": na[keep], "nb": nb[keep], "o": o[keep]})


def overlaps(rows: DataFrame, live: DataFrame, entries: int) -> DataFrame:
    """Pairs ``a, b`` of different groups whose overlap in the product reaches
    what their sizes demand. ``rows``: ``id, n, last_count, last_gram,
    component``; ``entries``: the counted rows of ``live``."""
    blocks = _blocks(entries)
    size = live.groupBy("id").agg(F.count(F.lit(1)).alias("live"))
    rows = rows.select("id", "component", "n", "last_count", "last_gram").join(size, "id")
    met = live.join(rows, "id")
    # one tile for a column, or all tiles that pair the row's part of it with another part
    own = F.pmod(F.xxhash64("id"), F.col("cut")).cast("int")
    tile = lambda j: F.struct(  # noqa: E731  side 0: all pairs, 1 and 2: only pairs across
        F.xxhash64("gram", F.least(own, j), F.greatest(own, j)).alias("tile"),
        F.when(own == j, 0).when(own < j, 1).otherwise(2).alias("side"))
    one = F.array(F.struct(F.pmod("gram", F.lit(blocks)).alias("tile"), F.lit(0).alias("side")))
    met = met.withColumn("at", F.explode(F.when(F.col("cut") == 1, one).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("cut") - 1), tile))))
    part = met.select(F.col("at.tile").alias("tile"), F.col("at.side").alias("side"), *(c for c in MET if c != "side")).groupBy("tile").applyInArrow(
        _multiplied, "a long, b long, na long, nb long, o long")
    whole = part.groupBy("a", "b", "na", "nb").agg(F.sum("o").alias("o"))
    need = _needed(F.col("na"), F.col("nb"))
    # what the entries outside the product could add is at most their number, for one of the two rows
    left = lambda n: need - (F.col(n) - _prefix_length_column(F.col(n)))
    return whole.where(F.col("o") >= F.least(left("na"), left("nb"))).select("a", "b")


def _prefix_length_column(n: Column) -> Column:
    up, down = SIMILAR
    return n - F.ceil(n * up / down - 1e-9) + 1


def jaccard_components(df: DataFrame, doc: str = "doc_id", text: str = "text", column: int = COLUMN) -> DataFrame:
    """One row per input row: ``id``, ``n`` (size of its set), ``component``
    (least id that links reach from it)."""
    docs = df.select(F.col(doc).cast("bigint").alias("id"), F.col(text).alias("text"))
    known, counts = summaries(docs)
    counts = df.sparkSession.sparkContext.broadcast(counts)  # of fixed size
    rows, seen = materialize(classes(docs, counts), "classes", {"entries": F.sum(F.length("prefix") / 8).cast("bigint")})
    near = materialize(contracted(rows, docs), "near-links")
    groups = components(near, "a", "b")
    grouped = rows.join(groups, "id", "left").withColumn("component", F.coalesce("component", "id"))
    live, kept = materialize(live_entries(grouped, seen["entries"] or 0, counts, column), "live", {"rows": F.count(F.lit(1))})
    pairs, found = materialize(overlaps(grouped, live, kept["rows"]), "pairs", {"rows": F.count(F.lit(1))})
    links = verified(pairs, docs, found["rows"]).unionByName(near)
    whole = components(links, "a", "b")
    rows = rows.select("n", "d1", "d2", "id").join(whole, "id", "left")
    rows = rows.select("n", "d1", "d2", F.coalesce("component", "id").alias("component"))
    return known.join(rows, ["n", "d1", "d2"], "left").select(
        "id", "n", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component"))
