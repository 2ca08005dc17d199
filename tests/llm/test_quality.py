import zlib

import numpy as np
from conftest import SF01
from helpers import docs, table
from pyspark.sql import functions as F

from sparkcivic.llm import q_quality, quality


def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in q_quality.query(spark, SF01).collect()}
    assert len(got) == len(table("documents", SF01))
    held = [r for r in table("labels", SF01) if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert all(got[r["doc_id"]]["held_out"] for r in held)
    right = [got[r["doc_id"]]["predicted"] == r["quality"] for r in held]
    assert len(held) > 80 and np.mean(right) >= 0.97
    scores = [r["score"] for r in got.values()]
    assert 0 <= min(scores) and max(scores) <= 1


def test_moments_equal_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, len(quality.STATS)))
    y = (rng.random(300) < 0.4).astype(int)
    x[y == 1] += 1
    df = spark.createDataFrame([(int(k), v.tolist()) for k, v in zip(y, x)] + [(None, x[0].tolist()), (7, x[1].tolist())], "label int, _stats array<double>")
    m = quality.fit(df, pool=0, diagonal=0)
    for k in (0, 1):
        assert np.allclose(m.means[k], x[y == k].mean(0))
        cov = np.cov(x[y == k].T, bias=True) + quality.FLOOR * np.eye(x.shape[1])
        assert np.allclose(m.whiten[k].T @ m.whiten[k], np.linalg.inv(cov))
        assert np.isclose(m.log_det[k], np.linalg.slogdet(cov)[1])
    assert np.mean((m.scores(x) >= 0.5) == y) > 0.9


def test_edge_rows(spark):
    texts = [None, "", " \n", "a", "word " * 100_000, "\u0000 ퟿", "a", "||| --- !!!"]
    df = docs(spark, texts + [(None, "x y z")], clash=True).select("*", quality.document_statistics(F.col("text")).alias("s"))
    assert all(len(r["s"]) == len(quality.STATS) and np.isfinite(r["s"]).all() for r in df.collect())
    one = spark.createDataFrame([(1, [0.0] * len(quality.STATS))] * 3, "label int, _stats array<double>")
    model = quality.fit(one)
    assert model.means is None and np.isclose(model.scores(np.zeros((2, 3)))[0], 0.8)
    assert np.isclose(quality.fit(one.limit(0)).prior, 0.5)
    assert df.limit(0).count() == 0
