import corpus_pipeline as cp
import numpy as np
import pytest
from conftest import SF001, SF01
from helpers import docs, table
from oracle_compare import compare, duck
from test_decontaminate import brute as brute_contamination
from test_jaccard import brute as brute_components
from test_packing import check

from sparkcivic.llm import pii, q_pii, registry
from sparkcivic.llm.common import table as read


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    problems, n, _ = compare(spark, SF01, name, registry.queries()[name], registry.oracle_sql()[name], duck(SF01))
    assert not problems and n > 0


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows after each stage."""
    docs, out = read(spark, SF01, "documents"), []
    for name, stage in cp.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "out")
        stage(spark, docs, SF01).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append([r.asDict() for r in docs.collect()])
    return out


def test_columns_and_order(stages):
    assert [n for n, _ in cp.STAGES] == ["quality", "near_copies", "decontaminate", "pii", "packing"]
    assert all(set(rows[0]) == set(cp.COLUMNS) for rows in stages[:4])


def test_quality_drops_bad_and_keeps_good(stages):
    kept = {r["doc_id"] for r in stages[0]}
    for quality, least, most in ((1, 0.98, 1), (0, 0, 0.03)):
        own = [r["doc_id"] in kept for r in table("labels", SF01) if r["quality"] == quality]
        assert least <= np.mean(own) <= most


def test_near_copies_keeps_one_of_each_group(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[0]]
    assert {r["doc_id"] for r in stages[1]} == {i for i, (_, c) in brute_components(rows).items() if c == i}


def test_decontaminate_drops_what_the_rule_says(stages):
    items = [(r["item_id"], r["text"]) for r in table("benchmark", SF01)]
    found = brute_contamination([(r["doc_id"], r["text"]) for r in stages[1]], items)
    assert {r["doc_id"] for r in stages[2]} == {d for d, n, h, _ in found if not (h and 20 * h >= n)}


def test_pii_replaces_texts_only(stages):
    p, before = pii.Permutation(q_pii.KEY.encode()), {r["doc_id"]: r for r in stages[2]}
    assert len(before) == len(stages[3])
    for r in stages[3]:
        text, found = pii.replace(before[r["doc_id"]]["text"], p)
        assert r["text"] == text and (found or r == before[r["doc_id"]])


def test_packing_packs_all(stages):
    used, least = check(stages[4], {r["doc_id"]: r["text"] for r in stages[3]})
    assert used <= least + 2


def test_run_gives_the_last_stage(spark, stages):
    key = lambda rows: sorted((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in rows)
    assert key(r.asDict() for r in cp.run(spark, SF01).collect()) == key(stages[4])


def test_edge_rows_through_all_stages(spark, tmp_path):
    texts = [None, "", "Same words in the same order here.", "Same words in the same order here.", "x " * 20_000, "a b"]
    rows = [(i if i != 5 else None, t, None, None, None) for i, t in enumerate(texts)] + [(2, texts[2], None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "1 AS component", "2 AS _score", "3 AS _pii")
    for name, stage in cp.STAGES:
        for df in (docs, docs.limit(0)):
            out = stage(spark, df, SF01)
            assert out.count() >= (len(texts) - 4 if df is docs else 0) * (name != "quality")
    kept = [r["doc_id"] for r in cp.near_copies(spark, docs, SF01).collect()]
    assert sorted(kept, key=str) == sorted([0, 1, 2, 4, None], key=str)


def test_near_copies_goes_by_rows_not_ids(spark):
    base = " ".join(f"w{k}" for k in range(60))
    texts = [(1, base), (2, base + " tail"), (2, "wholly different words that nobody else has"), (3, "first text of three"), (3, "second, other text of three"),
             (4, "alone"), (4, "alone"), (None, base), (None, "only here, without an id"), (None, None), (5, ""), (5, None), (0, "x " + base), (7, None)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    found = brute_components(list(enumerate(t for _, t in texts)))
    groups = {}
    for k, (_, component) in found.items():
        groups.setdefault(component, []).append(k)
    stays = [min(g, key=lambda k: (texts[k][0] is None, texts[k][0] or 0, k)) for g in groups.values()]
    got = [(r["doc_id"], r["text"]) for r in cp.near_copies(spark, docs, SF01).collect()]
    assert sorted(got, key=str) == sorted([texts[k] for k in stays], key=str)
    assert (2, "wholly different words that nobody else has") in got and len([g for g in got if g[0] == 3]) == 2


def test_stages_bound_the_batches_of_python_workers(spark):
    key, df = "spark.sql.execution.arrow.maxRecordsPerBatch", docs(spark, [f"some text {i}" for i in range(1500)]).coalesce(1)
    kept = spark.conf.get(key)
    try:
        for _, stage in cp.STAGES[3:4]:
            spark.conf.set(key, "10000")
            stage(spark, df, SF001)
            sizes = df.select("doc_id").mapInPandas(lambda parts: (p.iloc[:1].assign(doc_id=len(p)) for p in parts), "doc_id long").collect()
            assert max(r["doc_id"] for r in sizes) == cp.BATCH_ROWS
        spark.conf.set(key, "20")
        cp.STAGES[3][1](spark, df, SF001)
        assert spark.conf.get(key) == "20"
    finally:
        spark.conf.set(key, kept)
