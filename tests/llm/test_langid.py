import zlib

import numpy as np
import pytest
from conftest import SF01
from helpers import docs, table
from pyspark.sql import functions as F

from sparkcivic.llm import langid, q_langid


def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in q_langid.query(spark, SF01).collect()}
    truth = table("documents", SF01)
    assert len(got) == len(truth)
    held = [r for r in truth if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert all(got[r["doc_id"]]["held_out"] for r in held)
    assert np.mean([got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held]) >= 0.99


def texts(lang, n, seed):
    r = np.random.default_rng(seed)
    parts = {"aa": ["ba", "bo", "lu", "ma"], "bb": ["ski", "tre", "ne", "vo"], "cc": ["qui", "xa", "zo", "ju"]}[lang]
    return " ".join("".join(r.choice(parts, 3)) for _ in range(n))


def model(spark):
    rows = [(l, texts(l, 400, 1)) for l in ("aa", "bb", "cc")] + [(None, "ski"), ("aa", None), ("dd", "123")]
    return langid.fit(spark.createDataFrame(rows, "lang string, text string"))


def test_mixture(spark):
    m = model(spark)
    assert m.langs == ("aa", "bb", "cc")
    assert langid.infer(m, texts("bb", 50, 2))[0] == "bb"
    lang, share, found = langid.infer(m, texts("aa", 70, 3) + " " + texts("cc", 30, 4))
    assert lang == "aa" and set(found) == {"aa", "cc"} and 0.5 < share < 0.9 and abs(sum(found.values()) - 1) < 1e-6
    assert len(langid.infer(m, texts("bb", 80, 5))[2]) == 1


def test_em_equals_a_search_over_proportions():
    rng = np.random.default_rng(3)
    odds = rng.random((2, 40)) + 0.01
    n = rng.integers(1, 9, 40).astype(float)
    share, likely = langid.mixture(odds, n)
    best = max((float(np.log(a * odds[0] + (1 - a) * odds[1]) @ n), a) for a in np.linspace(0, 1, 2001))
    assert likely <= best[0] + 1e-9 and best[0] - likely < 0.05


def test_edge_rows(spark):
    m = model(spark)
    df = langid.identify(docs(spark, [None, "", "12 !?", "ski", "ski", (None, "ba bo"), "bolu " * 50_000], clash=True), m)
    got = [(r["doc_id"], r["_lang"]["lang"], r["_lang"]["score"]) for r in df.collect()]
    assert [x[1] for x in got] == ["und", "und", "und", "bb", "bb", "aa", "aa"] and all(0 <= x[2] <= 1 for x in got)
    assert df.limit(0).count() == 0
    none = langid.fit(spark.createDataFrame([], "lang string, text string"))
    assert langid.infer(none, "abc")[0] == "und"


def test_grams_take_signs_between_letters_as_one():
    assert sorted(langid.grams("a b")) == sorted(langid.grams("a, b")) == sorted(langid.grams("A\n9B"))


def test_a_column_of_free_text_is_refused_before_counting(spark):
    rows = spark.range(100_000).select(F.concat(F.lit("l"), "id").alias("lang"), F.lit("ba bo").alias("text"))
    with pytest.raises(ValueError, match="256"):
        langid.fit(rows)
    few = spark.range(200).select(F.concat(F.lit("l"), F.col("id") % 20).alias("lang"), F.lit("ba bo").alias("text"))
    assert len(langid.fit(few, most=20).langs) == 20
