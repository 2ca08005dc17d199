import pytest
from pyspark.sql import functions as F

from sparkcivic.operators import (any_code_match, explode_codes, first_present_column, project_cast,
                                  rate_by_group, require, topk_per_group, trim_names, union_eras)
from sparkcivic.plans import analyses
from sparkcivic.sources import code_dictionary, parse_csv_lines
from sparkcivic.sources.schemas import INCIDENTS


def test_trim_names_and_collision(spark):
    df = spark.createDataFrame([(1, 2)], "` a ` int, `b  ` int")
    assert trim_names(df).columns == ["a", "b"]
    clash = spark.createDataFrame([(1, 2)], "` a` int, `a ` int")
    with pytest.raises(ValueError):
        trim_names(clash)


def test_union_eras_by_name_keeps_duplicates(spark):
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([("x", 1)], "` v` string, `id ` int")
    out = union_eras(a, b)
    assert sorted(tuple(r) for r in out.collect()) == [(1, "x"), (1, "x")]
    c = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(Exception):
        union_eras(a, c).collect()


def test_first_present_column_uses_first_even_if_null(spark):
    df = spark.createDataFrame([(None, 5)], "`Zip Code` int, zip_code int")
    got = df.select(first_present_column(df, ["Zip Code", "zip_code"]).alias("z"),
                    first_present_column(df, ["nope"]).alias("n")).collect()[0]
    assert got.z is None and got.n is None


def test_project_cast_dirty(spark):
    df = spark.createDataFrame([("12", "x"), ("abc", "1.5")], "a string, b string")
    got = [tuple(r) for r in project_cast(df, {"a": ("a", "int"), "b": ("b", "double")}).collect()]
    assert got == [(12, None), (None, 1.5)]


def test_require_truthiness(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "s string")
    assert require(df, ["s"]).count() == 2
    assert require(df, ["s"], non_empty_text=True).count() == 1


def test_topk_tie_rules(spark):
    df = spark.createDataFrame([(1, "a", 9.0), (1, "b", 9.0), (1, "c", 8.0), (1, "d", 7.0), (1, "e", 6.0)],
                               "y int, k string, r double")
    dense = topk_per_group(df, ["y"], "r", 3, "dense").collect()
    rank = topk_per_group(df, ["y"], "r", 3, "rank").collect()
    row = topk_per_group(df, ["y"], "r", 3, "row", tiebreak=["k"]).collect()
    assert len(dense) == 4 and len(rank) == 3 and len(row) == 3
    assert [r.k for r in sorted(row, key=lambda r: r["rank"])] == ["a", "b", "c"]


def test_topk_plans_window_group_limit(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("y"), F.col("id").cast("double").alias("r"))
    plan = topk_per_group(df, ["y"], "r", 3, "dense")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_rate_decimal_vs_double(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("a", 0)], "k string, f int")
    d = rate_by_group(df, ["k"], "f").collect()[0]
    x = rate_by_group(df, ["k"], "f", decimal_digits=10).collect()[0]
    assert d.rate == pytest.approx(33.333333333333336)
    assert x.rate == 33.3333333333


def test_explode_and_any_code_match(spark):
    inc = spark.createDataFrame([(1, "0001 0002", 1.0), (2, "0003  x", 2.0), (3, None, 3.0), (1, "0002", 1.0)],
                                "id int, codes string, lat double")
    ex = explode_codes(inc, "codes", ["id"]).collect()
    assert [(r.id, r.code_str, r.code) for r in ex if r.id == 2] == [(2, "0003", 3), (2, "", None), (2, "x", None)]
    dic = spark.createDataFrame([(2, "gun"), (2, "gun again"), (3, "hand")], "code int, description string")
    hit = any_code_match(inc, "codes", dic, "code", ["id", "lat"]).collect()
    assert sorted(tuple(r) for r in hit) == [(1, 1.0), (2, 2.0)]


def test_code_dictionary_lines(spark):
    lines = spark.createDataFrame([("0100 Gun fired",), ("",), ("0400",), ("abc def",), (" 12 x",), (None,),
                                   ("0200   Knife  ",)], "value string")
    got = sorted(tuple(r) for r in code_dictionary(lines).collect())
    assert got == [(100, "Gun fired"), (200, "Knife"), (400, None)]


def test_parse_csv_lines_quotes_headers_short_rows(spark):
    header = ",".join(f.name for f in INCIDENTS.fields)
    lines = spark.createDataFrame([(header,), ('1,3,F,"a, b",30,d,1.5,2.5',), ("2,3,F,x",),
                                   (header,), ('3,3,F,"q ""z""",,d,1,2',)], "value string")
    got = parse_csv_lines(lines, INCIDENTS, header=header, required=["crime", "age"]).collect()
    assert [(r.dr_no, r.crime, r.age) for r in got] == [(1, "a, b", 30)]
    allrows = parse_csv_lines(lines, INCIDENTS, header=header).collect()
    assert [r.crime for r in allrows] == ["a, b", "x", 'q "z"']


def test_income_modes(spark):
    inc = spark.createDataFrame([("00001", "$1,000"), ("00002", "-"), ("00003", "$500"), ("4", "$300")],
                                "zip string, inc string")
    pop = spark.createDataFrame([("00001", 2.0), ("00002", 1.0), ("00003", 0.0), ("00004", 20.0)],
                                "zip string, hh float")
    pos = [tuple(r) for r in analyses.income_per_person(inc, pop, "positive").collect()]
    none = [tuple(r) for r in analyses.income_per_person(inc, pop, "none").collect()]
    bounded = [tuple(r) for r in analyses.income_per_person(inc, pop, "bounded").collect()]
    assert pos == [("00001", 500.0)]
    assert none == [("00001", 500.0), ("00002", None), ("00003", None)]
    assert bounded == [("00001", 500.0)]  # 00004 is padded but its household is above 15


def test_sql_topk_equals_dataframe_topk_with_same_rules(spark):
    from conftest import SF01
    from sparkcivic.plans import fixtures as fx
    inc = fx.incidents(spark, SF01)
    via_sql = analyses.topk_rate_sql(spark, inc, "date_occ", "area", "status", fx.OPEN_STATUSES)
    via_df = analyses.topk_rate(inc, "date_occ", "area", "status", fx.OPEN_STATUSES, ties="row",
                                decimal_digits=10)
    assert [tuple(r) for r in via_sql.collect()] == [tuple(r) for r in via_df.collect()]


def test_eras_of_different_types_meet_in_a_common_one(spark):
    from decimal import Decimal

    from sparkcivic.operators import common_type, misfits
    from pyspark.sql.types import DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, StringType, TimestampType
    assert common_type("c", [IntegerType(), LongType()]) == LongType()
    assert common_type("c", [FloatType(), IntegerType()]) == DoubleType()
    assert common_type("c", [DecimalType(9, 2), IntegerType()]) == DecimalType(12, 2)
    assert common_type("c", [DateType(), TimestampType()]) == TimestampType()
    for pair in ([IntegerType(), StringType()], [DecimalType(38, 30), LongType()], [LongType(), DoubleType()]):
        with pytest.raises(TypeError):
            common_type("c", pair)
    a = spark.createDataFrame([(1, Decimal("1.50"), 3)], " a int, b decimal(5,2), c int")
    b = spark.createDataFrame([(2 ** 40, 7, "x"), (None, 8, "12")], "a long, b int, `c ` string")
    with pytest.raises(TypeError, match="column c"):
        union_eras(a, b)
    got = union_eras(a, b, types="c int")
    assert dict(got.dtypes) == {"a": "bigint", "b": "decimal(12,2)", "c": "int"}
    assert sorted((tuple(r) for r in got.collect()), key=str) == [(1, Decimal("1.50"), 3), (2 ** 40, Decimal("7.00"), None), (None, Decimal("8.00"), 12)]
    assert misfits(b.toDF("a", "b", "c"), "c int").first().c == 1


@pytest.mark.parametrize("parts", [1, 7, 200])
def test_means_do_not_depend_on_the_partitions(spark, parts):
    from sparkcivic.operators import mean_rounded
    rows = [("tie", v) for v in (0.0005, 0.0005, 0.0015, 0.0015)] + [("third", 0.1 * k) for k in range(1000)] + [("big", 1e16), ("big", 1.0), ("big", -1e16)]
    rows += [("nan", float("nan")), ("nan", 1.0), ("none", None), ("huge", 1e30), ("huge", 1e30)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(parts)
    got = {r.k: (r["mean"], r["count"]) for r in mean_rounded(df, ["k"], "v", 3).collect()}
    assert got["tie"] == (0.001, 4) and got["third"] == (49.95, 1000) and got["big"] == (0.333, 3)
    assert got["nan"][0] != got["nan"][0] and got["none"] == (None, 1) and got["huge"] == (1e30, 2)


def test_sql_functions_are_the_column_functions(spark):
    from sparkcivic import functions as fn
    from sparkcivic.functions.bands import band_safe
    from sparkcivic.functions.sql import register_sql_functions
    assert "haversine_km" in register_sql_functions(spark) and register_sql_functions(spark)
    texts = ["17", "18", "24", "25", "64", "65", "-3", "", "abc", "12.0", None, "+7", "00001", "123456", "$1,234.5", " $-5 ", "NaN", "inf",
             "01/02/2020 12:00:00 AM", "13/40/2020 01:00:00 PM", "1/2/2021x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    same = df.select(
        F.expr("age_band_safe(t)").eqNullSafe(band_safe("t")), F.expr("age_band(try_cast(t AS BIGINT))").eqNullSafe(fn.band(F.col("t").try_cast("bigint"))),
        F.expr("incident_year(t)").eqNullSafe(fn.parse_year("t")), F.expr("incident_year_text(t)").eqNullSafe(fn.parse_year_text("t")),
        F.expr("money(t)").eqNullSafe(fn.clean_money("t")), F.expr("money_positive(t)").eqNullSafe(fn.clean_money_positive("t")),
        F.expr("zip5(t)").eqNullSafe(fn.zip_pad("t")))
    assert all(all(r) for r in same.collect())
    places = spark.createDataFrame([(0.0, 0.0, 0.0, 180.0), (90.0, 3.0, -90.0, 5.0), (34.1, -118.2, 34.0, -118.3), (None, 1.0, 1.0, 1.0)], "a double, b double, c double, d double")
    for r in places.select(F.expr("haversine_km(a, b, c, d)").alias("x"), fn.haversine_km("a", "b", "c", "d").alias("y")).collect():
        assert r.x == r.y or abs(r.x - r.y) < 1e-9
