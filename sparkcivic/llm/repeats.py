"""Removal of repeated passages by prefix-partitioned suffix trees.

A passage of ``length`` (50) words goes from a document if the same words also
start in a document with a smaller id. Such passages are the deep nodes of the
suffix tree of all documents: two suffixes with the same first 50 words pass
through one node of depth 50 or more. The tree is never built as a whole.

Which suffixes are met. Every window of 50 words chooses one of its 26 seeds
(25 words) by the least hash, so equal windows choose equal seeds at equal
places. Windows in a row that chose the same seed form a stretch; its suffixes
start up to 25 words before the seed and need the words of the stretch alone.

How they are divided. Suffixes can only meet behind the same seed, which is the
prefix that divides them. Only small rows are dealt by it: seed, digest of the
stretch, document (:func:`stretches`).
* Equal stretches are settled by the least document of each digest: all others
  lose every window of it. Copies, however many, end here.
* Seeds in one document, or in one stretch only, have no node below them.
* For other seeds, the first document of each different stretch hands over the
  stretch's words. Seeds are put together into groups of about ``GROUP``
  stretches, so that a group fits into a task, and the subtrees of a group are
  grown from the seeds word by word; suffixes that are alone become leaves and
  drop out (:func:`subtrees`). Nodes that reach the full depth are the repeats.
* A seed with more than ``HOT`` stretches (a sentence that many documents quote
  in different surroundings) is no group of one task. Its prefix is extended
  to the full depth: its windows are dealt out by their own digests, and the
  least document of each is an aggregate.

Copies of whole documents are found first by the digest of their words and take
no further part: the first of them holds all their windows.

Words count as equal by 64-bit hashes, stretches by 128 bits, windows by all
their words' hashes (128 bits of these for hot seeds).

Defined results
  * NULL and empty texts have no words; nothing is removed.
  * A NULL id is neither smaller nor larger than others: its text is kept.
  * Rows of one id are one document as regards smaller ids: they never remove
    each other's words, and each row is answered with its own text.
  * Documents shorter than a window are kept.
  * Very long texts are read whole, in parts that overlap by a window.
  * An empty table gives an empty result. Only the id and text columns are
    read, so further columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import id_text

LENGTH = 50
GROUP, HOT = 4096, 1024  # stretches of a group; stretches of one seed beyond which its prefix is extended
PART_BITS = 20  # 2**20 windows of a text are worked on at a time
CACHED = 1_000_000  # words whose hashes a Python worker remembers
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)  # any odd numbers
GONE, ASKED, ASKED_HOT = 0, 1, 2  # what a document is told of a stretch
NOTHING = hashlib.sha256(b"").hexdigest()


class Hashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED:
            self.clear()
        h = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of any run of a sequence: sums of words times powers."""

    def __init__(self, base: int):
        self.base, self.powers, self.inverse = base, np.zeros(0, np.uint64), np.zeros(0, np.uint64)

    def over(self, h: np.ndarray):
        if len(h) >= len(self.powers):
            n = 2 * len(h) + 2
            one = lambda b: np.cumprod(np.r_[np.uint64(1), np.full(n, b, np.uint64)], dtype=np.uint64)
            self.powers, self.inverse = one(self.base), one(pow(self.base, -1, 2 ** 64))
        sums = np.r_[np.uint64(0), np.cumsum(h * self.powers[:len(h)], dtype=np.uint64)]
        return lambda a, b: (sums[b] - sums[a]) * self.inverse[a]


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` keys in a row."""
    n, now, have = len(keys) - width + 1, keys, 1
    while 2 * have <= width:
        now = np.minimum(now[:len(now) - have], now[have:])
        have *= 2
    return now[:n] if have == width else np.minimum(now[:n], now[width - have:width - have + n])


class Stretches:
    """Cuts a text's hashed words into stretches: ``start`` and ``windows`` (of
    the windows that chose one seed), ``shift`` (from start to seed), ``seed``
    and ``digest``."""

    def __init__(self, length: int = LENGTH):
        if not 2 <= length <= 120:
            raise ValueError("windows have 2 to 120 words")
        self.length, self.seed_length = length, length // 2
        self.seeds, self.digests = map(Rolling, BASES)

    def cut(self, h: np.ndarray) -> dict[str, np.ndarray]:
        if len(h) < self.length:
            return dict.fromkeys(("start", "windows", "shift", "seed", "digest"), np.zeros(0, np.int64))
        step = 1 << PART_BITS
        parts = [self._cut(h[i:i + step + self.length - 1], i) for i in range(0, len(h) - self.length + 1, step)]
        return parts[0] if len(parts) == 1 else {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}

    def _cut(self, h: np.ndarray, offset: int) -> dict[str, np.ndarray]:
        places = np.arange(len(h) - self.seed_length + 1)
        seeds = _mixed(self.seeds.over(h)(places, places + self.seed_length))
        low = np.uint64(PART_BITS + 1)
        chosen = _least((seeds >> low << low) | places.astype(np.uint64), self.length - self.seed_length + 1)
        chosen = (chosen & ((np.uint64(1) << low) - np.uint64(1))).astype(np.int64)
        start = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
        windows = np.diff(np.r_[start, len(chosen)])
        seed = chosen[start]
        shape = (windows.astype(np.uint64) << np.uint64(8)) | (seed - start).astype(np.uint64)
        words = self.digests.over(_mixed(h ^ np.uint64(BASES[1])))(start, start + windows + self.length - 1)
        return {"start": start + offset, "windows": windows, "shift": seed - start, "seed": seeds[seed].view(np.int64),
                "digest": _mixed(words ^ _mixed(shape)).view(np.int64)}


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()  # at \x20 and \x09-\x0D, as for any bytes


def _described(length: int):
    def describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, cutter = Hashes(), Stretches(length)
        for batch in batches:
            rows = []
            for key, text in zip(batch["id"], batch["text"]):
                words = words_of(text)
                found = cutter.cut(hashes.of(words) if len(words) >= length and key is not None else np.zeros(0, np.uint64))
                digest, at = np.unique(found["digest"], return_index=True)
                rows.append((key, len(words), hashlib.sha256(b" ".join(words)).hexdigest(), found["seed"][at], digest))
            yield pd.DataFrame(rows, columns=["id", "n_words", "sha", "seed", "digest"])
    return describe


def _handed_over(length: int):
    def hand_over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, cutter = Hashes(), Stretches(length)
        columns = ["seed", "hot", "doc", "digest", "shift", "windows", "words"]
        for batch in batches:
            rows = []
            for key, text, asked, hot in zip(batch["id"], batch["text"], batch["asked"], batch["asked_hot"]):
                if not len(asked) and not len(hot):
                    continue
                h = hashes.of(words_of(text))
                found = cutter.cut(h)
                digests, at = np.unique(found["digest"], return_index=True)
                at = at[np.isin(digests, asked) | np.isin(digests, hot)]
                rest = [found[c][at].tolist() for c in ("start", "windows", "shift", "seed", "digest")]
                for a, n, shift, seed, digest, wide in zip(*rest, np.isin(found["digest"][at], hot).tolist()):
                    if not wide:
                        rows.append((seed, False, int(key), digest, shift, n, h[a:a + n + length - 1].tobytes()))
                        continue
                    for t in range(n):  # the window itself is the prefix
                        one = hashlib.blake2b(h[a + t:a + t + length].tobytes(), digest_size=16).digest()
                        rows.append((seed, True, int(key), digest, shift - t, t, one))
            yield pd.DataFrame(rows, columns=columns).astype({"shift": "int32", "windows": "int32"})
    return hand_over


def _numbered(*columns: np.ndarray) -> np.ndarray:
    """Equal rows get equal numbers."""
    order = np.lexsort(columns)
    new = np.zeros(len(order), dtype=bool)
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(new)
    return out


def subtrees(group: pd.DataFrame, length: int = LENGTH) -> pd.DataFrame:
    """``doc, digest, mask``: of the stretches of a group of seeds, the windows
    (one bit each) whose words also start in a smaller document. The subtrees
    are grown by one word at a time; ``node`` is where each suffix has come."""
    n = group["windows"].to_numpy(dtype=np.int64)
    words = np.frombuffer(b"".join(group["words"]), dtype=np.uint64)
    first = np.cumsum(np.r_[0, n + length - 1])[:-1]
    row = np.repeat(np.arange(len(n)), n)
    t = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    at, before = first[row] + t, group["shift"].to_numpy(dtype=np.int64)[row] - t
    node = _numbered(group["seed"].to_numpy()[row], before)
    for depth in range(length):
        many = np.bincount(node)[node] > 1  # the rest are leaves
        row, t, at, before, node = row[many], t[many], at[many], before[many], node[many]
        if not len(row):
            break
        read = np.where((depth < before) | (depth >= before + length // 2), words[at + depth], np.uint64(0))  # the seed is known to be equal
        if read.any():
            node = _numbered(read, node)
    doc = group["doc"].to_numpy(dtype=np.int64)
    least = np.full(node.max(initial=-1) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, node, doc[row])
    again = doc[row] > least[node]
    out = pd.DataFrame({"row": row[again], "mask": np.int64(1) << t[again]}).groupby("row", as_index=False)["mask"].sum()
    return pd.DataFrame({"doc": doc[out["row"]], "digest": group["digest"].to_numpy()[out["row"]], "mask": out["mask"]})


def _cut_out(length: int, with_text: bool):
    def cut_out(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, cutter = Hashes(), Stretches(length)
        for batch in batches:
            rows = []
            for key, text, gone, digests, masks in zip(batch["id"], batch["text"], batch["gone"], batch["digests"], batch["masks"]):
                words = words_of(text)
                found = cutter.cut(hashes.of(words))
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                whole = np.isin(found["digest"], gone)
                first, last = found["start"][whole], (found["start"] + found["windows"])[whole] - 1
                if digests is not None:
                    part = np.isin(found["digest"], digests) & ~whole
                    known = dict(zip(digests.tolist(), masks.tolist()))
                    bits = [(a, known[d]) for a, d in zip(found["start"][part].tolist(), found["digest"][part].tolist())]
                    starts = np.array([a + t for a, mask in bits for t in range(mask.bit_length()) if mask >> t & 1], dtype=np.int64)
                    first, last = np.r_[first, starts], np.r_[last, starts]
                np.add.at(edge, first, 1)
                np.add.at(edge, last + length, -1)
                kept = np.cumsum(edge)[:-1] == 0
                n, left = len(words) - int(kept.sum()), b" ".join(compress(words, kept))
                rows.append((key, hashlib.sha256(b" ".join(words)).hexdigest(), n, hashlib.sha256(left).hexdigest(), left.decode() if n and with_text else None))
            yield pd.DataFrame(rows, columns=["id", "sha", "n_removed", "kept_sha256", "kept"])
    return cut_out


def stretches(described: DataFrame) -> DataFrame:
    return described.select(F.col("id").cast("bigint").alias("doc"), F.explode(F.arrays_zip("seed", "digest")).alias("s")).select("doc", "s.*")


def remove_repeats(docs: DataFrame, doc: str = "doc_id", text: str = "text", length: int = LENGTH, group: int = GROUP, hot: int = HOT,
                   with_text: bool = False) -> DataFrame:
    """One row per input row: ``doc_id, n_words, n_removed, kept_sha256`` and,
    on request, ``kept``: the words that stay, joined by one space (NULL where
    nothing was removed, as the words are those of the text)."""
    rows = docs.select(id_text(F.col(doc)).alias("id"), F.col(text).alias("text"))
    base = materialize(rows.mapInPandas(_described(length), "id string, n_words long, sha string, seed array<long>, digest array<long>"), "repeats-base")
    whole = base.where((F.col("n_words") >= length) & F.col("id").isNotNull()).groupBy("sha").agg(F.min(F.col("id").cast("bigint")).alias("first"))
    whole = materialize(whole, "repeats-whole")
    firsts = base.join(whole.select("sha", F.col("first").cast("string").alias("id")), ["sha", "id"], "left_semi")
    cut = stretches(firsts)
    lead = materialize(cut.groupBy("seed", "digest").agg(F.min("doc").alias("lead"), F.max("doc").alias("last")), "repeats-lead")
    met = lead.groupBy("seed").agg(F.count(F.lit(1)).alias("n"), F.min("lead").alias("lo"), F.max("lead").alias("hi")).where("lo < hi")
    asked = lead.join(met, "seed").select(F.col("lead").alias("doc"), "digest", F.when(F.col("n") > hot, ASKED_HOT).otherwise(ASKED).alias("told"))
    gone = cut.join(lead.where("last > lead"), ["seed", "digest"]).where("doc > lead").select("doc", "digest", F.lit(GONE).alias("told"))
    pick = lambda what, name: F.collect_list(F.when(F.col("told") == what, F.col("digest"))).alias(name)
    told = gone.unionByName(asked).groupBy(F.col("doc").cast("string").alias("id")).agg(
        pick(GONE, "gone"), pick(ASKED, "asked"), pick(ASKED_HOT, "asked_hot"))
    touched = materialize(rows.join(told, "id"), "repeats-touched")

    over, seen = materialize(touched.select("id", "text", "asked", "asked_hot").mapInPandas(
        _handed_over(length), "seed long, hot boolean, doc long, digest long, shift int, windows int, words binary"), "repeats-words",
        {"n": F.count_if(~F.col("hot"))})
    groups = max(1, seen["n"] // group)
    marks = over.where(~F.col("hot")).withColumn("group", F.pmod("seed", F.lit(groups))).groupBy("group").applyInPandas(
        lambda part: subtrees(part, length), "doc long, digest long, mask long")
    wide = over.where("hot")
    least = wide.groupBy("seed", "shift", "words").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most")
    wide = wide.join(least, ["seed", "shift", "words"]).where("doc > least").groupBy("doc", "digest").agg(
        F.bit_or(F.expr("shiftleft(1L, windows)")).alias("mask"))
    marks = marks.unionByName(wide).groupBy(F.col("doc").cast("string").alias("id")).agg(
        F.collect_list(F.struct("digest", "mask")).alias("marks"))
    marks = marks.select("id", F.col("marks.digest").alias("digests"), F.col("marks.mask").alias("masks"))
    left = touched.select("id", "text", "gone").join(marks, "id", "left").mapInPandas(
        _cut_out(length, with_text), "id string, sha string, n_removed long, kept_sha256 string, kept string")
    left = left.dropDuplicates(["id", "sha"]) if with_text else left.drop("kept").dropDuplicates(["id", "sha"])

    out = base.select("id", "n_words", "sha").join(whole, "sha", "left").join(left, ["id", "sha"], "left")
    copy = F.col("id").cast("bigint") > F.col("first")
    kept = [F.when(copy, "").otherwise(F.col("kept")).alias("kept")] if with_text else []
    return out.select(F.col("id").cast("bigint").alias("doc_id"), "n_words",
                      F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("bigint"))).alias("n_removed"),
                      F.when(copy, NOTHING).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"), *kept)
