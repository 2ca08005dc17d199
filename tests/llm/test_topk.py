import math
import random

import pytest
from pyspark.sql import functions as F

from sparkcivic.llm import topk


def brute(rows, k=5, every=3):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, x in ok:
        if q % every == 0:
            best = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in ok if i != q and len(x) == len(y))[:k]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best)}
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df.withColumn("dim", F.lit(1)).withColumn("block", F.lit(1)), F.col("vec_id") % 3 == 0, **kw)
    return {tuple(r) for r in got.collect()}


@pytest.mark.parametrize("seed,shard,block", [(1, 8192, 512), (2, 16, 4), (3, 7, 1)])
def test_equals_brute_force_with_ties(spark, seed, shard, block):
    r = random.Random(seed)
    rows = [(i, [r.choice([-0.5, 0.0, 0.25, 0.126]) for _ in range(4)]) for i in range(120)]
    rows += [(200 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(12)]
    rows += [(300, None), (301, [None, 1.0]), (302, [float("nan")] * 4), (303, [float("inf")] * 4), (306, [1.0, 2.0]), (None, [1.0] * 4), (309, [0.0] * 4)]
    assert run(spark, rows, shard=shard, block=block) == brute(rows)


def test_stops_early_and_stays_exact():
    import numpy as np
    rng = np.random.default_rng(1)
    v = np.floor(256 * rng.normal(size=(4000, 3)) ** 3)
    s = topk.Shard(np.arange(4000), v, 5)
    read = 0
    for q in range(0, 4000, 400):
        got, n = s.top(q, v[q], 5)
        read += n
        assert got == [(-a, i) for a, i in sorted((-int(x), i) for i, x in enumerate(v @ v[q]) if i != q)[:5]]
    assert read < 0.5 * 10 * 4000  # the bound ends the reading before the lists do


def test_few_rows_large_numbers_and_empty_table(spark):
    rows = [(0, [1e12, 1e12]), (1, [1e12, -1e12]), (2, [1e11, 3e-3])]
    assert {(q, r, i) for q, r, i, _ in run(spark, rows)} == {(q, r, i) for q, r, i, _ in brute(rows)}
    assert run(spark, []) == set()


@pytest.mark.parametrize("copies", [1, 5, 6, 7, 20])
def test_a_repeated_query_row_hides_no_others(copies):
    import numpy as np
    ids = np.array([0] * copies + [1, 1, 2, 3, 4, 5, 6, 7])
    got, _ = topk.Shard(ids, np.ones((len(ids), 3)), 5).top(0, np.ones(3), 5)
    assert got == [(3, i) for i in (1, 1, 2, 3, 4)]


def test_a_bound_from_elsewhere_keeps_ties_and_spares_reading():
    import numpy as np
    rng = np.random.default_rng(2)
    v = np.floor(256 * rng.normal(size=(4000, 3)) ** 3)
    s = topk.Shard.read(3, *topk.Shard(np.arange(4000), v, 5).stored())
    for q in range(0, 4000, 400):
        want, n = s.top(q, v[q], 5)
        got, m = s.top(q, v[q], 5, want[2][0])
        assert got == [w for w in want if w[0] >= want[2][0]] and m <= n
        assert s.top(q, v[q], 5, want[0][0] + 1)[0] == []


@pytest.mark.parametrize("seed", [4, 5])
def test_many_rounds_of_queries_and_a_hot_row(spark, seed):
    r = random.Random(seed)
    rows = [(i, [r.choice([-0.5, 0.0, 0.25, 0.126]) for _ in range(3)]) for i in range(60)]
    rows += [(7, [0.5, 0.5, 0.5])] * 40 + [(400 + i, [0.5, 0.5, 0.5]) for i in range(30)] + [(500, []), (501, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = topk.top_k(df, F.col("vec_id") % 3 == 0, shard=8, block=2, sent=400)
    by = {}
    for q, rank, i, s in got.collect():
        by.setdefault(q, []).append((rank, i, s))
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    for q, x in ok:
        if q % 3 == 0:
            best = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in ok if i != q and len(x) == len(y))[:5]
            assert sorted(by.get(q, [])) == [(n + 1, i, -s) for n, (s, i) in enumerate(best)]


def test_vectors_are_shuffled_once_whatever_the_queries(spark, tmp_path):
    """The plan of the search holds the shards' table and no exchange of it."""
    df = spark.range(400).select(F.col("id").alias("vec_id"), F.array(*[F.rand(i) for i in range(4)]).alias("embedding"))
    df.write.parquet(str(tmp_path / "v"))
    df = spark.read.parquet(str(tmp_path / "v"))
    plan = topk.top_k(df, F.col("vec_id") % 2 == 0, shard=50, block=16)._jdf.queryExecution().executedPlan().toString()
    search = plan[plan.index("MapInPandas"):]
    assert "BroadcastHashJoin" in search and "Exchange hashpartitioning(dim" not in plan
