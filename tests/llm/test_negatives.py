import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkcivic.llm import negatives


def brute(rows, every=3):
    ok = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in rows
          if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, lab, x in ok:
        if a % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), i, o == lab) for i, o, y in ok if i != a and len(x) == len(y))
        for s, i, _ in [e for e in scored if e[2]][:5]:
            band = [e for e in scored if not e[2] and Fraction(80, 100) * -s <= -e[0] <= -s][:5]
            out += [(a, i, r + 1, j, -s, -t) for r, (t, j, _) in enumerate(band)]
    return sorted(out)


def run(spark, rows, every=3, **kw):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    for c in ("id", "dim", "block", "bucket", "rank", "length", "part", "known"):
        df = df.withColumn(c, F.lit("x"))
    return sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % every == 0, **kw).collect())


@pytest.mark.parametrize("seed,bucket,block,sent", [(1, 4096, 512, 64 << 20), (2, 16, 4, 600), (3, 7, 1, 64 << 20)])
def test_equals_brute_force_with_ties_at_any_size_of_parts(spark, seed, bucket, block, sent):
    r = random.Random(seed)
    rows = [(i, r.randint(0, 2), [r.choice([-0.5, 0.0, 0.25, 0.126, 0.9]) * r.choice([1, 1, 3]) for _ in range(4)]) for i in range(120)]
    rows += [(200 + i, i % 3, [0.5, 0.5, 0.5, 0.5]) for i in range(15)]
    rows += [(300, 1, None), (303, None, [1.0] * 4), (306, 1, [None, 1.0]), (309, 1, [float("nan")] * 4), (312, 1, [float("inf")] * 4),
             (315, 1, [1.0, 2.0]), (None, 1, [1.0] * 4), (318, 1, [0.0] * 4), (321, 9, [0.1] * 4), (3, rows[3][1], rows[3][2]), (7, rows[7][1], rows[7][2]),
             (330, 2, []), (333, 2, [])]
    assert run(spark, rows, bucket=bucket, block=block, sent=sent) == brute(rows)


def test_one_hot_vector_and_lengths_of_all_sizes(spark):
    r = random.Random(5)
    rows = [(i, i % 4, [0.3, 0.2, 0.1]) for i in range(300)] + [(300 + i, i % 4, [r.gauss(0, 1) * 10 ** r.randint(-3, 4) for _ in range(3)]) for i in range(200)]
    assert run(spark, rows, every=20, bucket=32) == brute(rows, every=20)


def test_large_numbers_few_rows_and_empty_table(spark):
    rows = [(0, 1, [1e6, 1e6]), (1, 1, [1e6, 1e3]), (2, 2, [0.9e6, 1.0]), (3, 2, [-1e6, 1e6])]
    assert run(spark, rows) == brute(rows) != []
    assert run(spark, []) == [] and run(spark, [(1, 1, [1.0])]) == []
    assert run(spark, [(0, 1, [1e300, 1e300]), (1, 1, [1e300, 1e300]), (2, 2, [1e300, 1e300])]) == [(0, 1, 1, 2, 2 ** 63 - 1, 2 ** 63 - 1)]


def bucket_of(data):
    n = len(data)
    return negatives.Bucket(data.shape[1], np.arange(n).tobytes(), np.zeros(n, dtype=np.int64).tobytes(), data.tobytes())


def test_the_ranges_lose_no_row_and_leave_few(spark):
    rng = np.random.default_rng(3)
    data = np.floor(256 * rng.normal(size=(3000, 3)) * rng.uniform(0.9, 1, size=(3000, 1)))
    b, left = bucket_of(data), 0
    for q in data[:60]:
        s = data @ q
        for bound in (np.sort(s)[-5], np.sort(s)[-50], 1.0):
            length = negatives.lengths(q[None])[0]
            got = b.candidates(q / length if length else q, length, bound)
            need = set(np.flatnonzero(s >= bound).tolist())
            assert got is None or need <= set(got.tolist())
            left += len(data) if got is None else len(got)
    assert left < 0.45 * 180 * len(data)


def test_a_bucket_of_short_rows_is_passed_over():
    b = bucket_of(np.array([[1.0, 1.0], [2.0, 0.0]]))
    assert len(b.candidates(np.array([1.0, 0.0]), 10.0, 21.0)) == 0
    assert b.candidates(np.array([1.0, 0.0]), 10.0, -5.0) is None
