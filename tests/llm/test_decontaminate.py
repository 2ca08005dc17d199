import random
import re

import pytest
from helpers import docs
from pyspark.sql import functions as F

from sparkcivic.llm import decontaminate as dec

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(rows, items, width=13):
    windows = {}
    for i, t in items:
        w = words(t)
        for s in range(max(1, len(w) - width + 1) if w and i is not None else 0):
            windows.setdefault(tuple(w[s:s + width]), set()).add(i)
    out = []
    for d, t in rows:
        w, hit, found = words(t), set(), set()
        for s in range(len(w)):
            for n in {len(x) for x in windows}:
                x = windows.get(tuple(w[s:s + n])) if s + n <= len(w) else None
                if x:
                    hit |= set(range(s, s + n))
                    found |= x
        out.append((d, len(w), len(hit), tuple(sorted(found))))
    return sorted(out, key=str)


def run(df, items, **kw):
    rows = dec.contamination(df, items, item_ids=True, **kw).withColumn("n_hit", dec.n_hit(F.col("_hits"))).withColumnRenamed("_items", "items")
    return sorted(((r["doc_id"], r["_n_words"], r["n_hit"], tuple(r["items"])) for r in rows.collect()), key=str)


def corpus(seed):
    r = random.Random(seed)
    vocab = ["the", "of", "É", "é", "Straße", "ab1", "x", "y", "z", "q9"]
    items = [(k, " ".join(r.choice(vocab) for _ in range(r.choice([1, 4, 13, 14, 20])))) for k in range(8)]
    items += [(20, items[3][1]), (21, None), (22, "  !"), (None, "the of"), (0, items[0][1])]
    rows = []
    for d in range(40):
        t = " ".join(r.choice(vocab) for _ in range(r.randrange(30)))
        if r.random() < 0.6:
            t += r.choice([" ", "--", "\n"]) + (r.choice(items)[1] or "").upper().replace("É", "é" if r.random() < 0.3 else "É")
        rows.append((d, t + " the of" * r.randrange(3)))
    return rows + [(50, None), (51, ""), (None, "the of x"), (7, rows[7][1])], items


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    rows, items = corpus(seed)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit(1)).withColumn("wid", F.lit(1))
    want = [(d, n, h, i) if d is not None else (d, n, 0, ()) for d, n, h, i in brute(rows, items)]
    assert run(docs(spark, rows, clash=True), bench) == sorted(want, key=str)


def test_shuffle_joins_give_the_same(spark, monkeypatch):
    rows, items = corpus(4)
    bench = spark.createDataFrame(items, "item_id long, text string")
    wide = run(docs(spark, rows), bench)
    monkeypatch.setattr(dec, "BROADCAST_BYTES", -1)
    assert run(docs(spark, rows), bench) == wide


def test_empty_tables_and_a_long_text(spark):
    rows = [(1, "a b c " * 40_000 + "p q r s t u v w x y z aa bb cc"), (2, "nothing")]
    bench = spark.createDataFrame([(5, "P q r s t u v w x y z aa bb cc")], "item_id long, text string")
    assert run(docs(spark, rows), bench) == brute(rows, [(5, "P q r s t u v w x y z aa bb cc")])
    assert [r[2] for r in run(docs(spark, rows), bench.limit(0))] == [0, 0]
    assert run(docs(spark, rows).limit(0), bench) == []


def test_proximity(spark):
    rows = [(1, "k1 a a k2 a k3"), (2, "k3 k1" + " a" * 30 + " k2"), (3, "k2 k1 k3 a k2")]
    items = spark.createDataFrame([(1, "k1 k2 k3")], "item_id long, text string")
    df = docs(spark, rows)
    windows = dec.test_windows(items)
    planned = dec.plan_windows(windows, dec.term_counts(df, windows))
    got = {(r["doc_id"], r["start"], r["span"]) for r in dec.proximity_matches(dec.build_index(df, planned), planned, slop=10).collect()}
    assert got == {(1, 0, 6), (3, 0, 3), (3, 1, 4)}


def test_native_plan(spark):
    rows, items = corpus(1)
    df = dec.contamination(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string"), item_ids=True)
    plan = df._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan


def test_greek_sigma_beside_other_signs(spark):
    text = "ΟΔΟΣ.ΑΘΗΝΑ ΑΣ'Β " + " ".join(f"word{i}" for i in range(9))
    rows, items = [(1, text), (2, "so " + text + " on"), (3, "other words")], [(0, text)]
    got = run(docs(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert got == brute(rows, items) and [n for _, _, n, _ in got] == [13, 13, 0]


def test_a_window_of_many_items(spark):
    """One sentence in 3,000 items and in 2,000 documents: their ids are gathered once, not once a document."""
    said = " ".join(f"w{i}" for i in range(13))
    rows = [(d, f"{said} own{d}" if d % 4 else f"no {d}") for d in range(2000)] + [(None, said)]
    items = [(i, said if i else "w1 w2 " + said) for i in range(3000)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = dec.contamination(docs(spark, rows), bench, item_ids=True).selectExpr(
        "doc_id", "size(_hits) AS n", "size(_items) AS k", "array_min(_items) AS least", "array_max(_items) AS last").collect()
    assert len(out) == 2001
    for r in out:
        assert (r.n, r.k, r.least, r.last) == ((1, 3000, 0, 2999) if r.doc_id is not None and r.doc_id % 4 else (0, 0, None, None))


def test_the_rarest_term_proposes_alone(spark):
    """A frequent posted term adds no place: only the rare one's places are looked at."""
    rows = [(d, "the of and " * 50) for d in range(20)] + [(90, "x rare the of"), (91, "rare the and")]
    items = spark.createDataFrame([(1, "rare the of")], "item_id long, text string")
    df = docs(spark, rows)
    windows = dec.test_windows(items)
    planned = dec.plan_windows(windows, dec.term_counts(df, windows))
    assert planned.first()["lead"][0]["term"] == "rare"
    got = {(r["doc_id"], r["start"]) for r in dec.phrase_candidates(dec.build_index(df, planned), planned).collect()}
    assert got == {(90, 1)}
