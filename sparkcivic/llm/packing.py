"""Best-fit packing of tokenised documents into sequences of fixed capacity.

``cut_pieces`` tokenises each whole text inside Arrow batches, ends it with a
separator id and cuts only what is longer than a sequence. ``pack`` deals the
pieces to shards of about ``SHARD`` rows by a hash of document and piece, and
packs each shard by best fit decreasing: the tightest open sequence is found
in logarithmic time in a segment tree over the remaining capacities. Token ids
never leave the tokenising task; only lengths and digests are shuffled. A
shard leaves at most a few sequences unfilled, out of thousands.

Tokenising goes by the vocabulary's units (words, digits, runs of signs), which
are found as array operations over the bytes of many texts and coded once and
not at each occurrence: a Python worker keeps the ids of at most ``CACHED``
units, those that came again first, in flat arrays. A unit is known by its
bytes, so no two are taken for one another. Texts with characters beyond a
plain set go through the tokenizer whole.

Defined results
  * NULL text counts as empty: one piece that holds the separator alone.
  * Repeated rows and NULL ids are packed like any others.
  * Equal lengths are packed in the order of document and piece.
  * An empty table gives an empty result. Only the id and text columns are
    read, so further columns cannot clash.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import id_text, whole_ids

CAPACITY, SEPARATOR = 2048, 0
SHARD = 32_768  # pieces that one task packs
CACHED = 400_000  # units that one Python worker remembers, about 60 bytes each
RUN_CHARS = 1_000_000  # characters whose units are found in one go
LEARNT = 500  # units that the tokenizer codes in one call
PIECES = "doc_id long, piece long, start long, length long, ids_crc32 long"


#: Texts of these characters alone: composing (NFC) leaves them as they are, lower-casing works letter by letter.
PLAIN = re.compile(r"[\t\n\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
#: The vocabulary's own rule for units, over plain lower-case text:
#: '(?:s|t|re|ve|m|ll|d)|letters|one digit|[^\s0-9 or letters]+, from left to right
SPECIAL = "<|"  # how the vocabulary's special tokens begin
BLANK, LETTER, DIGIT, SIGN = range(4)

_CUT = re.compile(r"[\t\n\r ]")
_KIND = np.full(256, SIGN, dtype=np.uint8)
_KIND[[9, 10, 13, 32]] = BLANK
_KIND[48:58] = DIGIT
_KIND[[*range(97, 123), *range(0xdf, 0xf7), *range(0xf8, 0x100)]] = LETTER
_MASKS = np.array([2 ** (8 * k) - 1 for k in range(9)], dtype=np.uint64)  # the first k bytes of a word of eight
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def unit_places(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of the units of ``raw``, Latin-1 bytes of plain
    lower-case texts that end with at least two blanks."""
    kind = _KIND[raw]
    edge = kind == DIGIT
    edge[0] = True
    edge[1:] |= kind[1:] != kind[:-1]
    at = np.flatnonzero(raw == ord("'"))
    at = at[edge[at]]  # inside a run of signs it is one of them
    one, two = raw[at + 1], raw[at + 2]
    is_ = lambda x, chars: np.isin(x, np.frombuffer(chars, dtype=np.uint8))
    long = ((one == ord("l")) & (two == ord("l"))) | (is_(one, b"rv") & (two == ord("e")))
    short = is_(one, b"stmd")
    edge[at[short | long] + 1] = False
    edge[at[short] + 2] = edge[at[long] + 3] = True
    edges = np.flatnonzero(edge)
    sizes = np.diff(edges, append=len(raw))
    full = kind[edges] != BLANK
    return edges[full], sizes[full]


class Units:
    """Ids of plain texts by way of their units, each of which the tokenizer
    codes on its own. Other texts are tokenised as they are. The result is the
    tokenizer's own in either case."""

    def __init__(self, path: str, cached: int = CACHED):
        from tokenizers import Tokenizer
        self.tokenizer, self.cached = Tokenizer.from_file(path), cached
        self.hash, self.low, self.high = (np.zeros(0, dtype=np.uint64) for _ in range(3))  # ascending hashes; the unit's bytes
        self.first, self.size, self.again = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
        self.ids = np.zeros(0, dtype="<u4")  # of unit i: ids[first[i]:][:size[i]]
        self.longer, self.numbered = {}, 0  # numbers of units of more than 16 bytes

    def keep(self, which: np.ndarray) -> None:
        """Forgets all units but these."""
        self.ids = self.ids[_stretches(self.first[which], self.size[which])]
        self.hash, self.low, self.high, self.size = (x[which] for x in (self.hash, self.low, self.high, self.size))
        self.first, self.again = np.cumsum(self.size) - self.size, np.zeros(len(which), dtype=bool)
        numbers = set((self.low[self.low & np.uint64(255) == 0] >> np.uint64(8)).tolist())
        self.longer = {u: i for u, i in self.longer.items() if i in numbers}

    def keys(self, data: bytes, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each unit's bytes as two numbers: no plain text holds a zero byte. A
        unit of more than 16 bytes has a number of its own, whose low byte is zero."""
        words = np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,))  # the eight bytes from each place on
        low, high = words[starts] & _MASKS[np.minimum(sizes, 8)], np.zeros(len(starts), dtype=np.uint64)
        more = np.flatnonzero(sizes > 8)
        high[more] = words[starts[more] + 8] & _MASKS[np.minimum(sizes[more] - 8, 8)]
        for i in np.flatnonzero(sizes > 16).tolist():
            unit = data[starts[i]:starts[i] + sizes[i]]
            if unit not in self.longer:
                self.numbered += 1
                self.longer[unit] = self.numbered
            low[i], high[i] = self.longer[unit] << 8, 0
        return low, high

    def learn(self, units: list[str], hashes: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        ids, sizes = [self.ids], []
        for a in range(0, len(units), LEARNT):
            some = units[a:a + LEARNT]
            e = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            sizes.append(np.bincount(np.array(e.word_ids, dtype=np.int64), minlength=len(some)))
            if len(sizes[-1]) != len(some) or not sizes[-1].all():
                raise ValueError("the tokenizer does not code units one by one")
            ids.append(np.array(e.ids, dtype="<u4"))
        sizes = np.concatenate(sizes)
        firsts = len(self.ids) + np.cumsum(sizes) - sizes
        self.ids = np.concatenate(ids)
        at = np.searchsorted(self.hash, hashes)
        new = {"hash": hashes, "low": low, "high": high, "first": firsts, "size": sizes, "again": False}
        for name, x in new.items():
            setattr(self, name, np.insert(getattr(self, name), at, x))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each of the ascending hashes, -1 if there is none."""
        at = np.searchsorted(self.hash, hashes)
        known = at < len(self.hash)
        known[known] = self.hash[at[known]] == hashes[known]
        return np.where(known, at, -1)

    def encode_plain(self, texts: list[str]) -> list[np.ndarray] | None:
        """None if two units have one hash."""
        if not texts:
            return []
        if len(self.hash) > self.cached:
            which = np.flatnonzero(self.again)
            self.keep(which if 2 * len(which) <= self.cached else which[:0])
        data = "\n".join([*texts, " " * 16]).encode("latin-1")
        starts, sizes = unit_places(np.frombuffer(data, dtype=np.uint8))
        low, high = self.keys(data, starts, sizes)
        of, hashes = pd.factorize(low + high * _SPREAD)
        here = np.zeros(len(hashes), dtype=np.int64)
        here[of] = np.arange(len(of))  # an occurrence of each
        order = np.argsort(hashes)
        hashes, here = hashes[order], here[order]
        place = self.find(hashes)
        new = np.flatnonzero(place < 0)
        self.again[place[place >= 0]] = True
        if len(new):
            w = here[new]
            self.learn([data[a:a + n].decode("latin-1") for a, n in zip(starts[w].tolist(), sizes[w].tolist())], hashes[new], low[w], high[w])
            place = self.find(hashes)
        back = np.empty(len(order), dtype=np.int64)
        back[order] = place
        place = back[of]
        if (self.low[place] != low).any() or (self.high[place] != high).any():
            self.keep(place[:0])
            return None
        size = self.size[place]
        ids = self.ids[_stretches(self.first[place], size)]
        ends = np.cumsum([len(t) + 1 for t in texts])
        return np.split(ids, np.concatenate([[0], np.cumsum(size)])[np.searchsorted(starts, ends)])[:-1]

    def encode_batch(self, texts: list[str]) -> Iterator[np.ndarray]:
        plain = [bool(PLAIN.fullmatch(t)) and SPECIAL not in t for t in texts]
        short = [p and len(t) <= RUN_CHARS for t, p in zip(texts, plain)]
        coded = self.encode_plain([t.lower() for t, s in zip(texts, short) if s])
        coded = iter(coded) if coded is not None else None
        for t, p, s in zip(texts, plain, short):
            if s and coded is not None:
                yield next(coded)
                continue
            parts = [self.encode_plain([x.lower()]) for x in _parts(t)] if p and not s else [None]
            if None in parts:
                yield np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u4")
            else:
                yield np.concatenate([x for x, in parts])


def _parts(text: str) -> Iterator[str]:
    """Parts of about ``RUN_CHARS`` characters, cut at a blank, where units end."""
    a = 0
    while a < len(text):
        at = _CUT.search(text, a + RUN_CHARS)
        b = at.start() if at else len(text)
        yield text[a:b]
        a = b


def _stretches(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places ``first[i]`` and following, ``size[i]`` of them, for each i."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(first - (ends - size), size)


def groups(texts: list[str], chars: int = RUN_CHARS) -> Iterator[list[int]]:
    """Places of texts, in runs of about ``chars`` characters."""
    run, n = [], 0
    for i, t in enumerate(texts):
        run.append(i)
        n += len(t)
        if n >= chars:
            yield run
            run, n = [], 0
    if run:
        yield run


_WORKER: dict[str, Units] = {}


def cut_pieces(df: DataFrame, path: str, doc: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``. ``path``: the tokenizer's
    file, which each executor reads from its own installation."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if path not in _WORKER:
            _WORKER[path] = Units(path)
        own = _WORKER[path]
        for batch in batches:
            docs, texts, rows = whole_ids(batch["doc_id"]), [t or "" for t in batch["text"].tolist()], []
            for run in groups(texts):
                for i, ids in zip(run, own.encode_batch([texts[i] for i in run])):
                    ids = np.append(ids, np.uint32(SEPARATOR)).astype("<u4", copy=False)
                    for k, s in enumerate(range(0, len(ids), capacity)):
                        part = ids[s:s + capacity]
                        rows.append((docs[i], k, s, len(part), zlib.crc32(part.tobytes())))
            names = ["piece", "start", "length", "ids_crc32"]
            out = pd.DataFrame([r[1:] for r in rows], columns=names, dtype="int64")
            out.insert(0, "doc_id", pd.array([r[0] for r in rows], dtype="Int64"))
            yield out
    return df.select(id_text(F.col(doc)).alias("doc_id"), F.col(text).alias("text")).mapInPandas(cut, PIECES)


class OpenBins:
    """Open bins by remaining capacity; a segment tree says which capacities
    have a bin."""

    def __init__(self, capacity: int):
        self.width = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.width)  # bins below each node
        self.bins: list[list[int]] = [[] for _ in range(self.width)]

    def _add(self, room: int, n: int) -> None:
        i = room + self.width
        while i:
            self.tree[i] += n
            i >>= 1

    def put(self, bin_: int, room: int) -> None:
        if room:
            self.bins[room].append(bin_)
            self._add(room, 1)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """Takes out a bin with the least room that is ``size`` or more."""
        i, tree = size + self.width, self.tree
        while not tree[i]:
            while i & 1:  # a right child: nothing to the right under this parent
                i >>= 1
            if not i:
                return None
            i += 1  # the right sibling
        while i < self.width:
            i = 2 * i if tree[2 * i] else 2 * i + 1
        room = i - self.width
        self._add(room, -1)
        return self.bins[room].pop(), room


def best_fit_decreasing(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; ties keep their order."""
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    open_bins, n = OpenBins(capacity), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        got = open_bins.tightest(size) if size < capacity else None
        if got is None:
            got, n = (n, capacity), n + 1
        bins[i], offsets[i] = got[0], capacity - got[1]
        open_bins.put(got[0], got[1] - size)
    return bins, offsets


def pack(pieces: DataFrame, rows: int, capacity: int = CAPACITY, shard: int = SHARD) -> DataFrame:
    """Adds ``sequence_id`` and ``offset``; ``rows``: the counted pieces."""
    shards = -(-rows // shard) or 1

    def packed(g: pd.DataFrame) -> pd.DataFrame:
        g = g.assign(doc_id=pd.array(whole_ids(g["doc_id"]), dtype="Int64")).sort_values(["doc_id", "piece", "start", "length", "ids_crc32"], kind="stable")
        bins, offsets = best_fit_decreasing(g["length"].to_numpy(), capacity)
        return g.assign(sequence_id=g["shard"].to_numpy() * (1 << 32) + bins, offset=offsets).drop(columns="shard")

    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards)))
    dealt = dealt.withColumn("doc_id", id_text(F.col("doc_id")))
    return dealt.groupBy("shard").applyInPandas(packed, PIECES + ", sequence_id long, offset long")


def tokenize_and_pack(df: DataFrame, path: str, doc: str = "doc_id", text: str = "text") -> DataFrame:
    pieces, seen = materialize(cut_pieces(df, path, doc, text), "pieces", {"rows": F.count(F.lit(1))})
    return pack(pieces, seen["rows"])
