"""Every registered query against its DuckDB oracle on the smallest tables,
plus plan-shape checks on the headline queries."""

import pytest

import __spark_entry__ as entry
from conftest import SF001
from oracle_compare import compare, duck

from sparkcivic.operators import sample_by_key, sample_rows
from sparkcivic.plans import queries
from sparkcivic.sources import write_bucketed

QUERIES = queries.queries()
ORACLE = queries.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_an_oracle_and_is_registered():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, con, key):
    problems, ns, nd = compare(spark, SF001, key, QUERIES[key], ORACLE[key], con)
    assert not problems, problems


def test_sample_rows_is_a_subset(spark):
    df = QUERIES["sample_rows"](spark, SF001)
    n, total = df.count(), QUERIES["union_eras"](spark, SF001).count()
    assert 0 < n < total


def test_bernoulli_sample_is_a_subset(spark):
    df = spark.range(2000)
    got = [r.id for r in sample_rows(df, 0.1).collect()]
    assert 0 < len(got) < 500 and len(set(got)) == len(got)


def test_key_sample_does_not_depend_on_partitions(spark):
    df = spark.range(5000).selectExpr("IF(id = 7, NULL, id) AS k")
    a, b = ({r.k for r in sample_by_key(d, "k", 0.2).collect()} for d in (df, df.repartition(7)))
    assert a == b and 800 < len(a) < 1200 and None not in a
    assert sample_by_key(df, "k", 0.0).count() == 0 and sample_by_key(df, "k", 1.0).count() == 4999
    assert sample_by_key(df, "k", None).count() == 5000


@pytest.mark.parametrize("key", ["parse_year", "filter_regex", "closed_flag", "age_bands"])
def test_no_join_where_the_area_is_not_used(spark, key):
    assert "Join" not in QUERIES[key](spark, SF001)._jdf.queryExecution().optimizedPlan().toString()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["year", "area", "closed_case_rate", "rank"]
    assert df.count() > 0


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_udf_evaluated_once_and_only_in_udf_key(spark):
    udf_plan = _plan(QUERIES["age_bands_udf"](spark, SF001))
    assert udf_plan.count("ArrowEvalPython") == 1 and "BatchEvalPython" not in udf_plan
    native_plan = _plan(QUERIES["age_bands"](spark, SF001))
    assert "EvalPython" not in native_plan


def test_scan_prunes_and_pushes(spark):
    df = QUERIES["scan_parquet"](spark, SF001)
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [", 1)[1].split("]", 1)[0]
    assert "EqualTo(o_orderstatus,F)" in pushed and "GreaterThan(o_total" in pushed  # the plan string truncates long lists
    schema = plan.split("ReadSchema: struct<", 1)[1].split(">", 1)[0]
    assert sorted(schema.split(",")) == ["o_custkey:bigint", "o_orderkey:bigint", "o_orderstatus:string",
                                         "o_totalprice:double"]


def test_nearest_summary_has_no_cartesian(spark):
    plan = _plan(QUERIES["nearest_site_summary"](spark, SF001))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_bucketed_join_has_no_exchange_below_it(spark):
    """Twice over the same tables: the second join needs no new division either."""
    income, census = queries.bucketed_by_zip(spark, SF001)
    for mode in ("positive", "none"):
        joined = queries.analyses.income_per_person(income, census.hint("merge"), mode)
        plan = _plan(joined)
        join = plan.index("SortMergeJoin")
        assert "Exchange" in plan[:join] and "Exchange" not in plan[join:].split("Initial Plan")[0]  # above it, for the order
    grouped = _plan(income.groupBy("zip").count())
    assert "Exchange" not in grouped


def test_bucketed_tables_keep_rows_and_odd_names(spark, tmp_path):
    df = spark.createDataFrame([(None, 1), ("", 2), ("a", 3), ("a", 3)], "`zip code` string, n int")
    got = write_bucketed(df, str(tmp_path / "t"), "zip code", 3)
    assert sorted(got.collect(), key=str) == sorted(df.collect(), key=str)
    assert write_bucketed(df.limit(0), str(tmp_path / "e"), "zip code", 3).columns == df.columns
    with pytest.raises(ValueError, match="at least one bucket"):
        write_bucketed(df, str(tmp_path / "x"), "zip code", 0)
