import hashlib
import random
import re

import numpy as np
import pandas as pd
import pytest

from helpers import docs
from sparkcivic.llm import repeats


def brute(rows, length):
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in split:
        for k in range(len(w) - length + 1):
            if i is not None:
                g = tuple(w[k:k + length])
                first[g] = min(first.get(g, i), i)
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - length + 1):
            if i is not None and first[tuple(w[k:k + length])] < i:
                gone |= set(range(k, k + length))
        kept = " ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, length, **kw):
    got = repeats.remove_repeats(docs(spark, rows, clash=True), length=length, **kw)
    return sorted((tuple(r) for r in got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=str)


def corpus(seed, n=60):
    r = random.Random(seed)
    word = lambda: r.choice(["a", "b", "wört", "x1", "new line"])
    passages = [[word() for _ in range(r.randint(8, 30))] for _ in range(6)]
    rows = []
    for i in range(n):
        w = []
        while len(w) < r.choice([5, 40, 90]):
            w += r.choice(passages) if r.random() < 0.5 else [f"{word()}{r.randint(0, 40)}" for _ in range(r.randint(1, 12))]
        rows.append((r.randint(-5, 1000), r.choice([" ", "\n", " \t "]).join(w)))
    rows += [(2000 + k, rows[k][1]) for k in range(8)] + [(rows[0][0], rows[1][1]), rows[2], (rows[3][0], None)]
    rows += [(3000, "y " * 200), (3001, "y " * 90 + "z"), (None, rows[0][1]), (3002, ""), (3003, " \n"), (3004, "short")]
    return rows


@pytest.mark.parametrize("seed,length,group,hot", [(1, 10, 8192, 2048), (2, 7, 4, 3), (3, 10, 50, 1), (4, 2, 100, 5)])
def test_equals_brute_force(spark, seed, length, group, hot):
    rows = corpus(seed)
    assert run(spark, rows, length, group=group, hot=hot) == brute(rows, length)


def test_passages_of_fifty_words_and_long_texts(spark, monkeypatch):
    r = random.Random(9)
    text = lambda n: [f"w{r.randint(0, 5000)}" for _ in range(n)]
    p, q = text(50), text(49)
    rows = [(1, " ".join(text(400) + p + text(300))), (2, " ".join(text(20) + p + text(7))), (3, " ".join(q)), (4, " ".join(text(3) + q + text(3))),
            (0, " ".join(text(30) + p)), (5, " ".join(text(20000) + p * 3 + text(20000)))]
    got = run(spark, rows, 50)
    assert got == brute(rows, 50)
    assert [r[2] for r in got] == [0, 50, 50, 0, 0, 150]


def test_parts_of_a_long_text_lose_no_window(monkeypatch):
    monkeypatch.setattr(repeats, "PART_BITS", 5)
    h = np.arange(1, 501, dtype=np.uint64) ** 3
    found = repeats.Stretches(10).cut(h)
    covered = np.concatenate([np.arange(a, a + n) for a, n in zip(found["start"], found["windows"])])
    assert covered.tolist() == list(range(491)) and set(found["shift"]) <= set(range(6))


def test_equal_windows_choose_equal_seeds_and_subtrees_find_them():
    r = np.random.default_rng(1)
    h = r.integers(1, 9, size=4000).astype(np.uint64)  # few different words
    found = repeats.Stretches(6).cut(h)
    where = {}
    for a, n, shift, seed in zip(*(found[c].tolist() for c in ("start", "windows", "shift", "seed"))):
        for t in range(n):
            where.setdefault(h[a + t:a + t + 6].tobytes(), set()).add((seed, shift - t))
    assert all(len(v) == 1 for v in where.values())
    group = pd.DataFrame({"seed": [1, 1, 1], "doc": [5, 3, 4], "digest": [50, 30, 40], "shift": [1, 1, 0], "windows": [2, 2, 1],
                          "words": [np.array(w, dtype=np.uint64).tobytes() for w in ([9, 1, 2, 3, 4, 5], [8, 1, 2, 3, 4, 5], [1, 2, 3, 4, 6])]})
    assert repeats.subtrees(group, 5).values.tolist() == [[5, 50, 2]]


def test_kept_text_and_empty_table(spark):
    rows = [(1, "a b c d e f"), (2, "x a b c d\ty"), (3, "a b c d e f")]
    got = {r["doc_id"]: r["kept"] for r in repeats.remove_repeats(docs(spark, rows), length=4, with_text=True).collect()}
    assert got == {1: None, 2: "x y", 3: ""}
    assert run(spark, [], 4) == []
