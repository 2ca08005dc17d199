import random
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from helpers import docs

from sparkcivic.llm import jaccard
from sparkcivic.llm.components import components


def words(t):
    return (t or "").encode().lower().split()


def brute_sets(t):
    w = words(t)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """doc_id -> (size, component) by comparing all pairs."""
    sets = [(i, brute_sets(t)) for i, t in rows]
    up = {i: i for i, _ in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for k, (i, x) in enumerate(sets):
        for j, y in sets[:k]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return {i: (len(x), root(i)) for i, x in sets}


def corpus(seed, n=60):
    r = random.Random(seed)
    vocab = [f"w{k}" for k in range(60)]
    base = [[r.choice(vocab) for _ in range(r.choice([3, 5, 6, 12, 40, 80]))] for _ in range(8)]
    passage = [r.choice(vocab) for _ in range(30)]
    rows = []
    for i in range(n):
        w = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 1, 2, 5])):
            w[r.randrange(len(w))] = r.choice(vocab)
        if r.random() < 0.2:
            w += passage
        rows.append((i, r.choice([" ", "\n", "\t "]).join(w).replace("w1", "W1" if r.random() < 0.5 else "w1")))
    return rows


@pytest.mark.parametrize("seed,column", [(1, 10 ** 6), (2, 10 ** 6), (3, 4)])
def test_components_equal_brute_force(spark, seed, column):
    rows = corpus(seed) + [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "ONE two"), (905, "Two one")]
    got = {r["id"]: (r["n"], r["component"]) for r in jaccard.jaccard_components(docs(spark, rows), column=column).collect()}
    assert got == brute(rows)


def test_without_contraction_and_in_tiles(spark, monkeypatch):
    """The product alone finds every link, also when columns are cut into tiles."""
    rows = corpus(4, 40)
    empty = spark.createDataFrame([], "a long, b long")
    monkeypatch.setattr(jaccard, "contracted", lambda *_: empty)
    for column in (10 ** 6, 3):
        got = {r["id"]: (r["n"], r["component"]) for r in jaccard.jaccard_components(docs(spark, rows), column=column).collect()}
        assert got == brute(rows)


def test_chain_of_near_copies(spark):
    """Ends of a chain are far from one another, yet one component."""
    w = [f"a{i}" for i in range(60)]
    rows = []
    for k in range(12):
        rows.append((100 - k, " ".join(w)))
        w = w[2:] + [f"b{k}x", f"b{k}y"]
    got = {r["id"]: r["component"] for r in jaccard.jaccard_components(docs(spark, rows)).collect()}
    assert set(got.values()) == {89} and {c for _, c in brute(rows).values()} == {89}


def test_large_ids_beside_a_null(spark):
    big = 2 ** 62 + 1
    df = docs(spark, [(big + 1, "a b c d e f"), (None, "x"), (big, "a b c d e f")]).coalesce(1)
    assert {(r["id"], r["component"]) for r in jaccard.jaccard_components(df).collect()} == {(big + 1, big), (big, big), (None, None)}


def test_edge_rows(spark):
    long = " ".join(f"x{i % 977}y{i % 13}" for i in range(60_000))
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (7, "a b c d e f"), (3, long), (2, long + " end"), (None, "a b c d e f"), (4, None)]
    got = sorted(((r["id"], r["component"]) for r in jaccard.jaccard_components(docs(spark, rows, clash=True)).collect()), key=str)
    assert got == sorted([(1, 1), (1, 1), (7, 1), (3, 2), (2, 2), (None, None), (4, 4)], key=str)
    assert jaccard.jaccard_components(docs(spark, rows).limit(0)).count() == 0


def test_ngram_sets_over_slices(monkeypatch):
    texts = ["a b c d e f g " * 30, "", "A  B\tc", "é É x\u00a0y z w v"]
    whole = jaccard.ngram_sets(texts)
    monkeypatch.setattr(jaccard, "SLICE_BYTES", 7)
    assert all(np.array_equal(a, b) for a, b in zip(whole, jaccard.ngram_sets(texts)))
    assert [len(s) for s in whole] == [len(brute_sets(t)) for t in texts]


def test_components_of_links(spark):
    links = [(5, 4), (4, 3), (3, 3), (9, 8), (None, 1), (8, 9), (7, 5), (20, 21)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {3: 3, 4: 3, 5: 3, 7: 3, 8: 8, 9: 8, 20: 20, 21: 20}


def _matrix(seed, rows, grams, groups):
    r = np.random.default_rng(seed)
    n = r.integers(5, 30, rows)
    live = np.array([r.integers(1, k - -(-k * 4 // 5) + 2) for k in n])
    group, last_count, last_gram = r.integers(0, groups, rows), r.integers(0, 4, rows), r.integers(0, 4, rows)
    at = np.array([(g, i) for i in range(rows) for g in sorted(set(r.integers(0, grams, 3).tolist()))])
    gram, i = at[:, 0], at[:, 1]
    side = np.where(gram == 0, 1 + i % 2, 0)
    return gram, i, group[i], n[i], live[i], last_count[i], last_gram[i], side


@pytest.mark.parametrize("seed,chunk", [(1, 10 ** 6), (2, 1), (3, 7)])
def test_product_equals_all_pairs(monkeypatch, seed, chunk):
    monkeypatch.setattr(jaccard, "PAIRS", chunk)
    m = _matrix(seed, 60, 8, 20)
    got = sorted((int(a), int(b)) for x in jaccard.product(*m) for a, b in zip(x[0], x[1]))
    gram, i, group, n, live, count, last, side = m
    want, ties = [], []
    for x in range(len(gram)):
        for y in range(x + 1, len(gram)):
            if gram[x] != gram[y] or group[x] == group[y] or side[x] and side[x] == side[y]:
                continue
            if min(n[x], n[y]) * 5 < max(n[x], n[y]) * 4:
                continue
            need = -(-(n[x] + n[y]) * 4 // 9)
            bound = {k: n[k] - (n[k] - -(-n[k] * 4 // 5) + 1 - live[k]) for k in (x, y)}
            pair = (int(min(i[x], i[y])), int(max(i[x], i[y])))
            if (count[x], last[x]) == (count[y], last[y]):  # either bound may judge a pair whose prefixes end alike
                ties.append((pair, [b >= need for b in bound.values()]))
            elif bound[min((x, y), key=lambda k: (count[k], last[k]))] >= need:
                want.append(pair)
    free = {p for p, ok in ties if len(set(ok)) == 2}
    want += [p for p, ok in ties if all(ok)]
    assert sorted(p for p in got if p not in free) == sorted(p for p in want if p not in free) and len(want) > 20


def test_a_hot_column_that_cannot_link_takes_seconds():
    """200,000 rows that share one n-gram and have lost too many others."""
    k = 200_000
    one, n = np.ones(k, dtype=np.int64), np.random.default_rng(1).integers(100, 120, k)
    t = time.monotonic()
    assert list(jaccard.product(one, np.arange(k), np.arange(k), n, one, n, n, 0 * one)) == []
    assert time.monotonic() - t < 5


def test_product_of_nothing():
    assert list(jaccard.product(*[np.zeros(0, dtype=np.int64)] * 8)) == []


def test_pairs_of_a_block_are_not_held_together():
    """Five million pairs in ten columns of 1,000 rows: each pair once, with all
    columns that it shares, in a fraction of the memory of all of them."""
    rows, columns = 1000, 10
    i, one = np.tile(np.arange(rows), columns), np.ones(rows * columns, dtype=np.int64)
    block = pa.table([np.repeat(np.arange(columns), rows), i, i, 100 * one, 21 * one, one, i, 0 * one], names=list(jaccard.MET))
    tracemalloc.start()
    try:
        got, n = np.zeros((rows, rows), dtype=np.int8), 0
        for x in jaccard._multiplied(iter(block.to_batches(max_chunksize=500))):
            got[x.column("a").to_numpy(), x.column("b").to_numpy()] += x.column("o").to_numpy().astype(np.int8)
            n += x.num_rows
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n == rows * (rows - 1) // 2 and np.array_equal(got, np.triu(np.full((rows, rows), columns, dtype=np.int8), 1))
    assert most < 100e6  # 639e6 when the pairs of a block were gathered before they were counted


@pytest.mark.parametrize("chunk", [1, 7, 10 ** 6])
def test_counted_adds_up_pairs_over_chunks(monkeypatch, chunk):
    monkeypatch.setattr(jaccard, "PAIRS", chunk)
    m = _matrix(5, 60, 8, 20)
    want = {}
    for x in jaccard.product(*m):
        for a, b in zip(x[0].tolist(), x[1].tolist()):
            want[a, b] = want.get((a, b), 0) + 1
    got = [(a, b, o) for x in jaccard.counted(jaccard.product(*m)) for a, b, o in zip(x[0].tolist(), x[1].tolist(), x[-1].tolist())]
    assert {(a, b): o for a, b, o in got} == want and len(got) == len(want) and max(want.values()) > 1
