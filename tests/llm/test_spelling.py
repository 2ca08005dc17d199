import random
import zlib
from collections import Counter

import pytest

from helpers import docs
from sparkcivic.llm import spelling


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, shortest=6, rarest=5, every=199, factor=5):
    """Letter by letter, and every word with every other."""
    counts = Counter()
    for i, text in rows:
        run = ""
        for c in (text or "") + " ":
            if "a" <= c <= "z" or "A" <= c <= "Z" or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
                continue
            if run:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                if h % every == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
                counts[run] += 1
            run = ""
    words = {w: n for w, n in counts.items() if len(w) >= shortest and n >= rarest}
    form, out = {}, set()
    close = {w: [v for v in words if near(w, v)] for w in words}
    for w, n in words.items():
        if close[w]:
            most = min(close[w], key=lambda v: (-words[v], v))
            if words[most] >= factor * n:
                form[w] = most
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(close[w]), words.get(form.get(w))))
    return out


def run(spark, rows, clash=True, **kw):
    return [tuple(r) for r in spelling.variants(docs(spark, rows, clash=clash), **kw).collect()]


def check(got, want):
    assert len(got) == len(set(got))
    assert set(got) == want


@pytest.mark.parametrize("seed,held", [(1, 1 << 17), (2, 60), (3, 12), (4, 1)])
def test_equals_brute_force_at_any_size_of_states(spark, seed, held):
    r = random.Random(seed)
    base = ["".join(r.choice("abé") for _ in range(r.randint(5, 8))) for _ in range(60)] + ["aaaaaa", "aaaaaaa", "aaaaaaaa"]
    rows = [(i, " ".join(r.choice(base[:r.choice([3, 20, 63])]) for _ in range(60))) for i in range(40)]
    rows += [(100, None), (101, ""), (None, "aaaaaa " * 9), (3, rows[3][1]), (102, "BÉTAaa ×÷ÿÀaa1" * 5)]
    check(run(spark, rows, held=held, rarest=2, drop_every=7), brute(rows, rarest=2, every=7))


def test_chains_of_forms_lead_to_one_root(spark):
    words = ["chained", "chainedx", "chainedxy", "chainedxyz", "chainedxyzz", "ahainedxyzz"]
    rows = [(k, " ".join([w] * 2 * 5 ** (5 - k))) for k, w in enumerate(words)]
    got = run(spark, rows, rarest=1, drop_every=10 ** 9)
    check(got, brute(rows, rarest=1, every=10 ** 9))
    assert {r[2] for r in got} == {"chained"}


def test_ties_go_by_code_points_and_edits_are_in_every_place(spark):
    rows = [(0, "abcdef " * 2 + "zbcdef xabcdef abcdefx abdef1 abcdeg " * 10 + "aabcdef bacdef abcdfe " * 10)]
    check(run(spark, rows, rarest=1), brute(rows, rarest=1))


def test_very_long_runs_and_empty_tables(spark):
    long = "ab" * 60_000
    rows = [(1, f"{long} {long}x {long[1:]} " * 5 + "short " * 50)]
    got = run(spark, rows, drop_every=10 ** 9)
    assert sorted((len(r[0]), r[4]) for r in got) == [(119_999, 1), (120_000, 2), (120_001, 1)]
    assert run(spark, []) == [] and run(spark, [(1, "too rare to count")]) == []


def test_the_acceptor_is_minimal():
    a = spelling.Acceptor(sorted(x + y for x in "abcd" for y in ["one", "onely", "two"]))
    reached, todo = set(), [0]
    while todo:
        s = todo.pop()
        if s not in reached:
            reached.add(s)
            todo += a.arcs[s].values()
    assert len(reached) == 9  # start, one state for all four letters, o, on, t, tw, one, onel, end


def test_a_common_prefix_is_split(spark):
    words = spark.createDataFrame([("prefix" + a + b + c, 5) for a in "abc" for b in "xyz" for c in "pqr"], "word string, n long")
    parts, opened = spelling.states(words, held=40)
    sizes = [r["s"] for p in parts for r in p.groupBy("state").agg({"word": "count"}).withColumnRenamed("count(word)", "s").collect()]
    assert sum(sizes) == 27 and max(sizes) <= 4 and len(opened) == 2
    assert spelling.near_pairs(words, held=40).count() == 27 * 6 // 2
