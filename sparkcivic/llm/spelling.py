"""Spelling variants by composing finite-state machines.

The vocabulary's acceptor A is composed with a one-edit transducer E and with A
again; a pair that A . E . A accepts is two words that differ by one inserted,
deleted or replaced code point. E is unambiguous: it reads the words' longest
common prefix, makes its edit there, and must then read equal rests, so every
pair is accepted along one path only.

The pairs are enumerated per initial state. A state of A is the set of words
that share a prefix. Starting with the initial state, a state whose words hold
more than ``HELD`` code points is opened: it first moves down to where its words
branch, and each branch is a state of its own (:func:`states`). So the parts
have prefixes of varying length and fit into a task whatever prefix is common.

* Pairs that part inside one state are enumerated by a task
  (:func:`accepted_pairs`): it builds the minimal acceptor of its words, and
  walks the composition depth first. Two states that no common rest leads out
  of are remembered as dead.
* Pairs that part at an opened state have spent their edit there. Their rests
  are equal, so they are found by equi joins on (opened state, rest). A group
  of equal rests holds at most one word per letter, all near each other.

Counting (:func:`vocabulary`) tallies words inside each task and sums them over
tasks. Forms are the first near word by count; chains of forms are followed by
doubling, in as many joins as the logarithm of the longest chain.

Defined results
  * NULL and empty texts hold no words. A NULL id is written as no characters.
  * Repeated rows count as often as they occur.
  * Near words of equal count go by code-point order.
  * An empty table, or no word that is frequent enough: an empty result.
  * Only the id and text columns are read, so further columns cannot clash.
  * Runs of any length are words; texts are read whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from os.path import commonprefix

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ..session import materialize
from .common import id_text, maybe_broadcast

SHORTEST, RAREST, DROP_EVERY, FORM_FACTOR = 6, 5, 199, 5
HELD = 1 << 17  # code points of words that one task composes
TALLIED = 300_000  # different words that a task tallies before it hands them on
BROADCAST_ROWS = 50_000
RUN = re.compile("[a-zÀ-ÿ]+")
PAIR = "a string, na long, b string, nb long"


def ascii_lower(text: str) -> str:
    return text.lower() if text.isascii() else text.encode().lower().decode()


def altered(run: str, h: int, drop_every: int = DROP_EVERY) -> str:
    """The run without its code point ``h % length`` if ``drop_every`` divides ``h``."""
    if h % drop_every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _tallied(shortest: int, drop_every: int):
    def tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()

        def out() -> pd.DataFrame:
            rows = pd.DataFrame(list(counts.items()), columns=["word", "n"]).astype({"n": "int64"})
            counts.clear()
            return rows
        for batch in batches:
            for key, text in zip(batch["id"], batch["text"]):
                if not text:
                    continue
                seed = zlib.crc32(f"{key or ''}:".encode())
                for run, n in Counter(RUN.findall(ascii_lower(text))).items():
                    h = zlib.crc32(run.encode(), seed)
                    word = run if h % drop_every else altered(run, h, drop_every)
                    if len(word) >= shortest:
                        counts[word] += n
                if len(counts) >= TALLIED:
                    yield out()
        if counts:
            yield out()
    return tally


def vocabulary(docs: DataFrame, doc: str = "doc_id", text: str = "text", shortest: int = SHORTEST, rarest: int = RAREST,
               drop_every: int = DROP_EVERY) -> DataFrame:
    """``word, n``: words of at least ``shortest`` code points that occur ``rarest`` times or more."""
    rows = docs.select(id_text(F.col(doc)).alias("id"), F.col(text).alias("text"))
    words = rows.mapInPandas(_tallied(shortest, drop_every), "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= rarest)


class Acceptor:
    """The minimal deterministic acceptor of ascending words. States are
    numbers; ``arcs[s]`` maps a letter to the next state, ``final[s]`` tells
    whether a word may end."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = [{}]
        self.final: list[bool] = [False]
        known: dict[tuple, int] = {}
        path, last = [0], ""

        def settle(depth: int) -> None:  # states below that depth get no more arcs
            while len(path) > depth + 1:
                s = path.pop()
                same = known.setdefault((self.final[s], *self.arcs[s].items()), s)
                self.arcs[path[-1]][last[len(path) - 1]] = same
        for word in words:
            settle(len(commonprefix([word, last])))
            for letter in word[len(path) - 1:]:
                self.arcs.append({})
                self.final.append(False)
                self.arcs[path[-1]][letter] = len(self.arcs) - 1
                path.append(len(self.arcs) - 1)
            self.final[path[-1]] = True
            last = word
        settle(0)


class Composition:
    """Enumerates the pairs that acceptor . one edit . acceptor accepts."""

    def __init__(self, acceptor: Acceptor):
        self.arcs, self.final = acceptor.arcs, acceptor.final
        self.dead: set[tuple[int, int]] = set()

    def rests(self, s: int, t: int, barred: str | None = None) -> Iterator[str]:
        """What is read from ``s`` to an end and from ``t`` to an end alike,
        ``barred`` not being the first letter."""
        if (s, t) in self.dead:
            return
        walk: list = []  # per open pair of states: pair, letters to go, whether a rest was found, how it was reached

        def enter(s: int, t: int, by: str, barred: str | None) -> bool:
            a, b = self.arcs[s], self.arcs[t]
            letters = [x for x in (a if len(a) <= len(b) else b) if x in a and x in b and x != barred]
            ends = self.final[s] and self.final[t]
            walk.append([(s, t) if barred is None else None, letters, ends, by, s, t])
            return ends
        if enter(s, t, "", barred):
            yield ""
        while walk:
            top = walk[-1]
            if top[1]:
                letter = top[1].pop()
                nxt = (self.arcs[top[4]][letter], self.arcs[top[5]][letter])
                if nxt not in self.dead and enter(*nxt, letter, None):
                    yield "".join(w[3] for w in walk)
            else:
                walk.pop()
                if not top[2] and top[0] is not None:
                    self.dead.add(top[0])
                if walk and top[2]:
                    walk[-1][2] = True

    def parting(self, s: int) -> Iterator[tuple[str, str]]:
        """Pairs of rests from state ``s`` whose edit is made at ``s``."""
        letters = sorted(self.arcs[s].items())
        for k, (x, t) in enumerate(letters):
            for y, u in letters[k + 1:]:
                for rest in self.rests(t, u):
                    yield x + rest, y + rest
            for rest in self.rests(t, s, barred=x):
                yield x + rest, rest

    def pairs(self) -> Iterator[tuple[str, str]]:
        prefix: list[str] = []
        todo = [iter(self.arcs[0].items())]
        yield from self.parting(0)
        while todo:
            step = next(todo[-1], None)
            if step is None:
                todo.pop()
                if prefix:
                    prefix.pop()
                continue
            prefix.append(step[0])
            found = list(self.parting(step[1]))
            if found:
                head = "".join(prefix)
                for a, b in found:
                    yield head + a, head + b
            todo.append(iter(self.arcs[step[1]].items()))


def accepted_pairs(part: pd.DataFrame) -> pd.DataFrame:
    """Near pairs among the words of one state, each once."""
    n = dict(zip(part["word"], part["n"]))
    words = sorted(n)
    cut = len(commonprefix([words[0], words[-1]]))
    head = words[0][:cut]
    pairs = Composition(Acceptor([w[cut:] for w in words])).pairs()
    rows = [(head + a, n[head + a], head + b, n[head + b]) for a, b in pairs]
    return pd.DataFrame(rows, columns=["a", "na", "b", "nb"]).astype({"na": "int64", "nb": "int64"})


@F.pandas_udf(LongType())
def _branching(first: pd.Series, last: pd.Series) -> pd.Series:
    return pd.Series([len(commonprefix([a, b])) for a, b in zip(first, last)], dtype="int64")


def states(words: DataFrame, held: int = HELD) -> tuple[list[DataFrame], list[DataFrame]]:
    """Frames of ``state, word, n`` in states of at most ``held`` code points
    (or one word), and of ``at, word, n`` at the depth of each opened state."""
    parts, opened = [], []
    todo = words.select(F.lit("").alias("state"), "word", "n")
    while True:
        size = todo.groupBy("state").agg(F.sum(F.char_length("word")).alias("held"), F.min("word").alias("first"),
                                         F.max("word").alias("last"))
        large = size.where((F.col("held") > held) & (F.col("first") < F.col("last"))).select(
            "state", _branching("first", "last").alias("at"))
        large, seen = materialize(large, "spelling-open", {"n": F.count(F.lit(1))})
        if not seen["n"]:
            return [*parts, todo], opened
        large = maybe_broadcast(large, seen["n"], BROADCAST_ROWS)
        parts.append(todo.join(large, "state", "left_anti"))
        at = materialize(todo.join(large, "state").select("at", "word", "n"), "spelling-opened")
        opened.append(at)
        todo = at.where(F.char_length("word") > F.col("at")).select(  # a word that ends at the branching has no state
            F.expr("left(word, at + 1)").alias("state"), "word", "n")


def _parted(opened: DataFrame) -> DataFrame:
    """Near pairs that part at an opened state, each once."""
    head = F.expr("left(word, at)")
    rest = F.expr("substring(word, at + 2)")
    one = opened.where(F.char_length("word") > F.col("at")).select(head.alias("head"), rest.alias("rest"), "word", "n")
    none = opened.select(head.alias("head"), F.expr("substring(word, at + 1)").alias("rest"), F.col("word").alias("b"), F.col("n").alias("nb"))
    one_b = one.select("head", "rest", F.col("word").alias("b"), F.col("n").alias("nb"))
    replaced = one.join(one_b, ["head", "rest"]).where("word < b")
    # the shorter word must not go on with the letter that the longer one has there
    deleted = one.join(none, ["head", "rest"]).where(
        "char_length(b) = char_length(word) - 1 and substring(word, char_length(head) + 1, 1) <> substring(b, char_length(head) + 1, 1)")
    pick = [F.col("word").alias("a"), F.col("n").alias("na"), "b", "nb"]
    return replaced.select(*pick).unionByName(deleted.select(*pick))


def near_pairs(words: DataFrame, held: int = HELD) -> DataFrame:
    """``a, na, b, nb``: every two near words, once, with their counts."""
    parts, opened = states(words, held)
    todo = parts[0]
    for p in parts[1:]:
        todo = todo.unionByName(p)
    pairs = todo.groupBy("state").applyInPandas(lambda part: accepted_pairs(part), PAIR)
    for at in opened:
        pairs = pairs.unionByName(_parted(at))
    return pairs


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``word, form`` links that lead to no circle."""
    now, seen = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots", {"n": F.count(F.lit(1))})
    moved = seen["n"]
    while moved:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = now.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("_moved"))
        now, seen = materialize(step, "spelling-roots", {"n": F.count_if("_moved")})
        now, moved = now.drop("_moved"), seen["n"]
    return now


def variants(docs: DataFrame, doc: str = "doc_id", text: str = "text", shortest: int = SHORTEST, rarest: int = RAREST,
             drop_every: int = DROP_EVERY, factor: int = FORM_FACTOR, held: int = HELD) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the vocabulary."""
    words = materialize(vocabulary(docs, doc, text, shortest, rarest, drop_every), "spelling-words")
    pairs = near_pairs(words, held)
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("na").alias("n"), F.col("b").alias("near"), F.col("nb").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("nb").alias("n"), F.col("a").alias("near"), F.col("na").alias("near_n")))).alias("p")).select("p.*")
    most = both.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("most"))
    is_form = -F.col("most.less") >= F.lit(factor) * F.col("n")
    most = materialize(most.select("word", "n_near", F.when(is_form, F.col("most.near")).alias("form"),
                                   F.when(is_form, -F.col("most.less")).alias("form_n")), "spelling-near")
    ends = roots(most.where("form is not null").select("word", "form"))
    out = words.join(most, "word", "left").join(ends, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                      F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), "form_n")
