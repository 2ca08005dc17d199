"""Registry of queries: name -> (Spark callable, DuckDB oracle SQL or None).

Every callable takes ``(spark, sf_dir)``, reads the driver tables under
``sf_dir`` and returns a lazy DataFrame over the whole tables. Keys that
exercise a sink write their input to a fresh folder under the shared
``spark.checkpoint.dir`` and return what reading it back gives.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .. import functions as fn
from ..operators import (drop_null_island, explode_codes, first_present_column,
                         flag_not_in, project_cast, require, sample_by_key, trim_names, union_eras)
from ..functions.sql import register_sql_functions
from ..operators.aggregate import mean_rounded
from ..session import scratch_path
from ..sources import (Source, code_dictionary, ingest, parse_csv_lines, read_csv, read_numbered_lines, read_parquet, read_text,
                       write_bucketed, write_csv, write_parquet, write_text)
from ..sources import schemas
from . import analyses
from . import fixtures as fx
from .oracle import OPEN, TS_FORMAT, haversine_sql, pad, spark_round, sql_list, with_ctes

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def query(name: str, sql: str | None):
    def deco(f: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (f, sql)
        return f
    return deco


BAND_SQL = """CASE WHEN {a} < 18 THEN 'Children' WHEN {a} <= 24 THEN 'Young Adults'
                  WHEN {a} <= 64 THEN 'Adults' ELSE 'Elderly' END"""
YEAR_SQL = f"CAST(year(try_strptime(date_occ, '{TS_FORMAT}')) AS INTEGER)"
YEAR_TEXT_SQL = "TRY_CAST(substr(split_part(date_occ, '/', 3), 1, 4) AS INTEGER)"
AGE_BANDS_SQL = with_ctes(["incidents"], f"""
SELECT {BAND_SQL.format(a='age')} AS age_group, count(*) AS count
FROM incidents
WHERE crime IS NOT NULL AND age IS NOT NULL AND regexp_matches(crime, '{fx.CRIME_PATTERN}')
GROUP BY 1""")


# --------------------------------------------------------------------- Q1 ---

@query("age_bands", AGE_BANDS_SQL)
def q_age_bands(spark, sf):
    return analyses.band_counts(fx.incidents_alone(spark, sf), "age", "crime", fx.CRIME_PATTERN)


@query("age_bands_udf", AGE_BANDS_SQL)
def q_age_bands_udf(spark, sf):
    return analyses.band_counts(fx.incidents_alone(spark, sf), "age", "crime", fx.CRIME_PATTERN, how="udf")


AGE_TEXT_SQL = with_ctes(["incidents"], f"""
SELECT CASE WHEN TRY_CAST(t AS INTEGER) IS NULL THEN 'Unknown'
            ELSE {BAND_SQL.format(a='TRY_CAST(t AS INTEGER)')} END AS age_group,
       count(*) AS count
FROM (SELECT crime, CASE WHEN dr_no % 19 = 0 THEN 'n/a' ELSE CAST(age AS VARCHAR) END AS t
      FROM incidents) s
WHERE contains(lower(crime), '{fx.CRIME_WORD}')
GROUP BY 1""")


@query("age_bands_safe", AGE_TEXT_SQL)
def q_age_bands_safe(spark, sf):
    inc = fx.incidents_alone(spark, sf)
    text_age = F.when(F.col("dr_no") % 19 == 0, F.lit("n/a")).otherwise(F.col("age").cast("string"))
    hits = inc.filter(fn.contains_any(F.col("crime"), [fx.CRIME_WORD]))
    return (hits.select(fn.band_safe(text_age).alias("age_group"))
            .groupBy("age_group").agg(F.count(F.lit(1)).alias("count")))


@query("age_bands_udf_text", AGE_TEXT_SQL)
def q_age_bands_udf_text(spark, sf):
    inc = fx.incidents_alone(spark, sf)
    text_age = F.when(F.col("dr_no") % 19 == 0, F.lit("n/a")).otherwise(F.col("age").cast("string"))
    hits = inc.filter(fn.contains_any(F.col("crime"), [fx.CRIME_WORD]))
    return (hits.select(fn.band_udf()(text_age).alias("age_group"))
            .groupBy("age_group").agg(F.count(F.lit(1)).alias("count")))


def _incident_csv_lines(spark, sf) -> tuple[DataFrame, str]:
    """The incidents as raw CSV text lines: one folder per era, each with its
    own header line; the ``premise`` field holds a quoted comma."""
    first, second = fx.incident_eras(spark, sf)
    cols = ["dr_no", "area", "status", "crime", "age", "date_occ", "lat", "lon", "premise"]
    header = ",".join(cols)

    def lines(df, era):
        df = df.withColumn("premise", F.concat(F.col("crime"), F.lit(", area "), F.col("area")))
        return df.select(F.to_csv(F.struct(*cols)).alias("value"), F.lit(era).alias("era"))

    headers = spark.createDataFrame([(header, 1), (header, 2)], "value string, era int")
    raw = headers.unionByName(lines(first, 1)).unionByName(lines(trim_names(second), 2))
    path = scratch_path(spark, "incident-lines")
    raw.write.mode("errorifexists").partitionBy("era").text(path)  # one job, era=1/ and era=2/
    return read_text(spark, path).select("value"), header


@query("csv_lines", with_ctes(["incidents"], f"""
SELECT {BAND_SQL.format(a='age')} AS age_group, count(*) AS count
FROM incidents
WHERE crime IS NOT NULL AND crime <> '' AND age IS NOT NULL
  AND contains(lower(crime), '{fx.CRIME_WORD}')
GROUP BY 1"""))
def q_csv_lines(spark, sf):
    lines, header = _incident_csv_lines(spark, sf)
    schema = StructType(schemas.INCIDENTS.fields + [StructField("premise", StringType())])
    rows = parse_csv_lines(lines, schema, header=header, required=["crime", "age"])
    hits = rows.filter(fn.contains_any(F.col("crime"), [fx.CRIME_WORD]))
    banded = hits.select(fn.band_safe(F.col("age")).alias("age_group")).filter(F.col("age_group") != fn.UNKNOWN)
    return banded.groupBy("age_group").agg(F.count(F.lit(1)).alias("count"))


# --------------------------------------------------------------------- Q2 ---

Q2_BASE = f"""
SELECT {YEAR_SQL} AS year, area,
       CASE WHEN status NOT IN ({OPEN}) THEN 1 ELSE 0 END AS closed
FROM incidents
WHERE date_occ IS NOT NULL AND area IS NOT NULL AND status IS NOT NULL
  AND NOT (lat = 0.0 AND lon = 0.0)"""


@query("topk_rate_dense", with_ctes(["incidents"], f"""
, agg AS (SELECT year, area, count(*) AS total, sum(closed) AS closed FROM ({Q2_BASE}) b GROUP BY year, area)
, rates AS (SELECT year, area, CAST(closed AS DOUBLE) / total * 100 AS closed_case_rate FROM agg)
SELECT * FROM (
  SELECT year, area, closed_case_rate,
         CAST(dense_rank() OVER (PARTITION BY year ORDER BY closed_case_rate DESC) AS INTEGER) AS rank
  FROM rates) r
WHERE rank <= 3"""))
def q_topk_rate_dense(spark, sf):
    return analyses.topk_rate(fx.incidents(spark, sf), "date_occ", "area", "status", fx.OPEN_STATUSES)


@query("topk_rate_sql", with_ctes(["incidents"], f"""
, agg AS (SELECT year, area, count(*) AS total, sum(closed) AS closed FROM ({Q2_BASE}) b GROUP BY year, area)
, rates AS (SELECT year, area, CAST(round(100.0 * closed / total, 10) AS DOUBLE) AS closed_case_rate FROM agg)
SELECT * FROM (
  SELECT year, area, closed_case_rate,
         CAST(row_number() OVER (PARTITION BY year ORDER BY closed_case_rate DESC, area) AS INTEGER) AS rank
  FROM rates) r
WHERE rank <= 3"""))
def q_topk_rate_sql(spark, sf):
    return analyses.topk_rate_sql(spark, fx.incidents(spark, sf), "date_occ", "area", "status",
                                  fx.OPEN_STATUSES)


@query("topk_rate_exact", with_ctes(["incidents"], f"""
, b AS (
  SELECT {YEAR_TEXT_SQL} AS year, area, CASE WHEN status NOT IN ({OPEN}) THEN 1 ELSE 0 END AS closed
  FROM incidents
  WHERE date_occ IS NOT NULL AND date_occ <> '' AND area IS NOT NULL
    AND status IS NOT NULL AND status <> ''
    AND NOT (lat IS NOT DISTINCT FROM 0.0 AND lon IS NOT DISTINCT FROM 0.0))
, agg AS (SELECT year, area, count(*) AS total, sum(closed) AS closed FROM b WHERE year IS NOT NULL GROUP BY year, area)
SELECT * FROM (
  SELECT year, area, CAST(closed AS DOUBLE) / total * 100 AS closed_case_rate,
         CAST(row_number() OVER (PARTITION BY year ORDER BY CAST(closed AS DOUBLE) / total * 100 DESC, area)
              AS INTEGER) AS rank
  FROM agg) r
WHERE rank <= 3"""))
def q_topk_rate_exact(spark, sf):
    return analyses.topk_rate(fx.incidents(spark, sf), "date_occ", "area", "status", fx.OPEN_STATUSES,
                              ties="row", year_from="text", null_safe_island=True,
                              keep_null_year=False, non_empty_text=True)


@query("agg_multi_key", with_ctes(["incidents"], f"""
SELECT year, area, count(*) AS total, CAST(sum(closed) AS BIGINT) AS closed
FROM ({Q2_BASE}) b GROUP BY year, area"""))
def q_agg_multi_key(spark, sf):
    inc = drop_null_island(require(fx.incidents(spark, sf), ["date_occ", "area", "status"]))
    base = inc.select(fn.parse_year("date_occ").alias("year"), "area",
                      flag_not_in("status", fx.OPEN_STATUSES).alias("closed"))
    return base.groupBy("year", "area").agg(F.count(F.lit(1)).alias("total"),
                                            F.sum("closed").alias("closed"))


@query("agg_conditional", with_ctes(["incidents"], f"""
SELECT area, count_if(status NOT IN ({OPEN})) AS closed_count, count(*) AS total
FROM incidents GROUP BY area"""))
def q_agg_conditional(spark, sf):
    inc = fx.incidents(spark, sf)
    return inc.groupBy("area").agg(F.count_if(~F.col("status").isin(*fx.OPEN_STATUSES)).alias("closed_count"),
                                   F.count(F.lit(1)).alias("total"))


@query("avg_rounded", with_ctes(["incidents"], f"""
SELECT area, {spark_round('avg(age)', 3)} AS mean, count(*) AS count
FROM incidents WHERE age IS NOT NULL GROUP BY area"""))
def q_avg_rounded(spark, sf):
    inc = fx.incidents(spark, sf).filter(F.col("age").isNotNull())
    return mean_rounded(inc, ["area"], "age", 3)


@query("distinct_rows", with_ctes(["incidents"], """
SELECT DISTINCT area, status FROM incidents"""))
def q_distinct_rows(spark, sf):
    return fx.incidents(spark, sf).select("area", "status").distinct()


@query("closed_flag", with_ctes(["incidents"], f"""
SELECT dr_no, status, CASE WHEN status NOT IN ({OPEN}) THEN 1 ELSE 0 END AS closed FROM incidents"""))
def q_closed_flag(spark, sf):
    inc = fx.incidents_alone(spark, sf)
    return inc.select("dr_no", "status", flag_not_in("status", fx.OPEN_STATUSES).alias("closed"))


@query("parse_year", with_ctes(["incidents"], f"""
SELECT dr_no, date_occ, {YEAR_SQL} AS year FROM incidents"""))
def q_parse_year(spark, sf):
    return fx.incidents_alone(spark, sf).select("dr_no", "date_occ", fn.parse_year("date_occ").alias("year"))


@query("parse_year_text", with_ctes(["incidents"], f"""
SELECT dr_no, date_occ, {YEAR_TEXT_SQL} AS year FROM incidents"""))
def q_parse_year_text(spark, sf):
    return fx.incidents_alone(spark, sf).select("dr_no", "date_occ", fn.parse_year_text("date_occ").alias("year"))


@query("format_report", with_ctes(["incidents"], f"""
, agg AS (SELECT year, area, count(*) AS total, sum(closed) AS closed FROM ({Q2_BASE}) b GROUP BY year, area)
, rates AS (SELECT year, area, CAST(closed AS DOUBLE) / total * 100 AS r FROM agg)
SELECT year, area, printf('%.2f', {spark_round('r', 2)}) AS closed_case_rate,
       '#' || CAST(rank AS VARCHAR) AS rank
FROM (SELECT year, area, r, dense_rank() OVER (PARTITION BY year ORDER BY r DESC) AS rank FROM rates) x
WHERE rank <= 3"""))
def q_format_report(spark, sf):
    top = analyses.topk_rate(fx.incidents(spark, sf), "date_occ", "area", "status", fx.OPEN_STATUSES)
    return top.select("year", "area", fn.fixed_decimals("closed_case_rate", 2).alias("closed_case_rate"),
                      fn.rank_label("rank").alias("rank"))


# --------------------------------------------------------------------- Q3 ---

def _pp(expr_inc: str, expr_hh: str) -> str:
    return spark_round(f"CAST({expr_inc} AS DOUBLE) / NULLIF(CAST({expr_hh} AS DOUBLE), 0)", 2)


CLEAN_FLOAT = "TRY_CAST(replace(replace(inc, '$', ''), ',', '') AS FLOAT)"


@query("income_per_person", with_ctes(["income", "census"], f"""
SELECT i.zip, {_pp('i.v', 'c.h')} AS income_per_person
FROM (SELECT zip, {CLEAN_FLOAT} AS v FROM income) i
JOIN (SELECT zip, hh AS h FROM census) c ON i.zip = c.zip
WHERE i.v > 0 AND c.h > 0"""))
def q_income_per_person(spark, sf):
    return analyses.income_per_person(fx.income(spark, sf), fx.census(spark, sf), "positive")


ZIP_BUCKETS = 16


def bucketed_by_zip(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Income and census as tables bucketed alike on the ZIP."""
    return tuple(write_bucketed(t(spark, sf), scratch_path(spark, "by-zip"), "zip", ZIP_BUCKETS) for t in (fx.income, fx.census))


@query("income_per_person_bucketed", with_ctes(["income", "census"], f"""
SELECT i.zip, {_pp('i.v', 'c.h')} AS income_per_person
FROM (SELECT zip, {CLEAN_FLOAT} AS v FROM income) i
JOIN (SELECT zip, hh AS h FROM census) c ON i.zip = c.zip
WHERE i.v > 0 AND c.h > 0"""))
def q_income_per_person_bucketed(spark, sf):
    """A merge join, bucket by bucket: nothing is shuffled or broadcast below it."""
    income, census = bucketed_by_zip(spark, sf)
    return analyses.income_per_person(income, census.hint("merge"), "positive")


@query("income_per_person_bounded", with_ctes(["income", "census"], f"""
SELECT i.zip, {_pp('i.v', 'c.h')} AS income_per_person
FROM (SELECT zip, TRY_CAST(replace(replace(trim(inc), '$', ''), ',', '') AS DOUBLE) AS v FROM income) i
JOIN (SELECT zip, CAST(hh AS DOUBLE) AS h FROM census) c ON i.zip = c.zip
WHERE i.v > 0 AND c.h > 0 AND c.h <= 15"""))
def q_income_per_person_bounded(spark, sf):
    return analyses.income_per_person(fx.income(spark, sf), fx.census(spark, sf), "bounded")


DIRTY_HH = "TRY_CAST(CASE WHEN CAST(zip AS BIGINT) % 13 = 0 THEN 'n/a' ELSE CAST(hh AS VARCHAR) END AS {})"


def _dirty_census(spark, sf) -> DataFrame:
    """Household sizes as text, one in thirteen not a number."""
    return fx.census(spark, sf).select("zip", F.when(F.col("zip").cast("bigint") % 13 == 0, F.lit("n/a"))
                                       .otherwise(F.col("hh").cast("string")).alias("hh"))


def _dirty_sql(money: str, size: str, where: str) -> str:
    return with_ctes(["income", "census"], f"""
SELECT i.zip, {_pp('i.v', 'c.h')} AS income_per_person
FROM (SELECT zip, {money} AS v FROM income) i
JOIN (SELECT zip, {DIRTY_HH.format(size)} AS h FROM census) c ON i.zip = c.zip {where}""")


@query("income_dirty_positive", _dirty_sql(CLEAN_FLOAT, "FLOAT", "WHERE i.v > 0 AND c.h > 0"))
def q_income_dirty_positive(spark, sf):
    return analyses.income_per_person(fx.income(spark, sf), _dirty_census(spark, sf), "positive")


@query("income_dirty_none", _dirty_sql(CLEAN_FLOAT, "FLOAT", ""))
def q_income_dirty_none(spark, sf):
    return analyses.income_per_person(fx.income(spark, sf), _dirty_census(spark, sf), "none")


@query("income_dirty_bounded", _dirty_sql("TRY_CAST(replace(replace(trim(inc), '$', ''), ',', '') AS DOUBLE)", "DOUBLE",
                                          "WHERE i.v > 0 AND c.h > 0 AND c.h <= 15"))
def q_income_dirty_bounded(spark, sf):
    return analyses.income_per_person(fx.income(spark, sf), _dirty_census(spark, sf), "bounded")


def _csv_copy(spark, df: DataFrame, name: str, header: bool = True) -> str:
    return write_csv(df, scratch_path(spark, name), header=header)


@query("income_per_person_csv", with_ctes(["income", "census"], f"""
SELECT i.zip, {_pp('i.v', 'c.hh')} AS income_per_person
FROM (SELECT zip, {CLEAN_FLOAT} AS v FROM income) i JOIN census c ON i.zip = c.zip"""))
def q_income_per_person_csv(spark, sf):
    inc_path = _csv_copy(spark, fx.income(spark, sf), "income-csv")
    pop_path = _csv_copy(spark, fx.census(spark, sf), "census-csv")
    inc = read_csv(spark, inc_path, schema=schemas.INCOME)
    pop = read_csv(spark, pop_path, schema=schemas.CENSUS)
    return analyses.income_per_person(inc, pop, "none")


@query("clean_money", with_ctes(["income"], f"""
SELECT zip, inc, {CLEAN_FLOAT} AS amount FROM income"""))
def q_clean_money(spark, sf):
    inc = fx.income(spark, sf)
    return inc.select("zip", "inc", fn.clean_money("inc").alias("amount"))


@query("clean_money_positive", with_ctes(["income"], """
SELECT zip, inc, CASE WHEN v > 0 THEN v END AS amount
FROM (SELECT zip, inc, TRY_CAST(replace(replace(trim(inc), '$', ''), ',', '') AS DOUBLE) AS v FROM income) s"""))
def q_clean_money_positive(spark, sf):
    inc = fx.income(spark, sf)
    return inc.select("zip", "inc", fn.clean_money_positive("inc").alias("amount"))


@query("zip_pad", """
SELECT c_custkey,
       CASE WHEN length(s) >= 5 THEN s
            WHEN left(s, 1) IN ('+', '-') THEN left(s, 1) || lpad(substr(s, 2), 4, '0')
            ELSE lpad(s, 5, '0') END AS zip
FROM (SELECT c_custkey, CAST(c_custkey - 700 AS VARCHAR) AS s FROM customer) t""")
def q_zip_pad(spark, sf):
    c = fx.read(spark, sf, "customer", "c_custkey")
    return c.select("c_custkey", fn.zip_pad(F.col("c_custkey") - 700, 5).alias("zip"))


@query("join_inner_using", with_ctes(["income", "census"], """
SELECT i.zip, i.inc, c.hh FROM income i JOIN census c ON i.zip = c.zip"""))
def q_join_inner_using(spark, sf):
    return fx.income(spark, sf).join(fx.census(spark, sf), on="zip", how="inner").select("zip", "inc", "hh")


@query("first_n", with_ctes(["income", "census"], f"""
SELECT i.zip, {_pp('i.v', 'c.h')} AS income_per_person
FROM (SELECT zip, {CLEAN_FLOAT} AS v FROM income) i
JOIN (SELECT zip, hh AS h FROM census) c ON i.zip = c.zip
WHERE i.v > 0 AND c.h > 0
ORDER BY i.zip LIMIT 10"""))
def q_first_n(spark, sf):
    # a sorted first-n: planned as TakeOrderedAndProject (per-task top-n, no full sort)
    return analyses.income_per_person(fx.income(spark, sf), fx.census(spark, sf), "positive").limit(10)


@query("first_present_column", with_ctes(["income"], """
SELECT zip, inc AS income_text, CAST(NULL AS VARCHAR) AS missing FROM income"""))
def q_first_present_column(spark, sf):
    inc = fx.income(spark, sf)
    return inc.select("zip",
                      first_present_column(inc, ["Estimated Median Income", "inc", "Income"]).alias("income_text"),
                      first_present_column(inc, ["Income", "income"]).cast("string").alias("missing"))


@query("project_cast", with_ctes(["census"], """
SELECT TRY_CAST(zip AS INTEGER) AS zip_code, CAST(hh AS DOUBLE) AS household FROM census"""))
def q_project_cast(spark, sf):
    return project_cast(fx.census(spark, sf), {"zip_code": ("zip", "int"), "household": ("hh", "double")})


# --------------------------------------------------------------------- Q4 ---

@query("explode_codes", with_ctes(["incidents_codes"], """
SELECT dr_no, code_str, TRY_CAST(code_str AS INTEGER) AS code
FROM (SELECT dr_no, unnest(string_split(mocodes, ' ')) AS code_str
      FROM incidents_codes WHERE mocodes IS NOT NULL) e"""))
def q_explode_codes(spark, sf):
    return explode_codes(fx.incidents_with_codes(spark, sf), "mocodes", ["dr_no"])


@query("join_inner_expr", with_ctes(["incidents_codes", "dictionary"], """
SELECT e.dr_no, e.code, d.description
FROM (SELECT dr_no, TRY_CAST(unnest(string_split(mocodes, ' ')) AS INTEGER) AS code
      FROM incidents_codes WHERE mocodes IS NOT NULL) e
JOIN dictionary d ON e.code = d.code"""))
def q_join_inner_expr(spark, sf):
    e = explode_codes(fx.incidents_with_codes(spark, sf), "mocodes", ["dr_no"])
    d = fx.dictionary(spark, sf)
    return e.join(d, e.code == d.code).select(e.dr_no, e.code, d.description)


@query("filter_contains", f"""
SELECT p_partkey, p_name FROM part WHERE {' OR '.join(f"contains(lower(p_name), '{w}')" for w in fx.WEAPON_WORDS)}""")
def q_filter_contains(spark, sf):
    p = fx.read(spark, sf, "part", "p_partkey", "p_name")
    return p.filter(fn.contains_any("p_name", fx.WEAPON_WORDS))


@query("any_code_match", with_ctes(["weapon_points"], "SELECT dr_no, lat, lon FROM weapon_points"))
def q_any_code_match(spark, sf):
    return analyses.weapon_incidents(fx.incidents_with_codes(spark, sf), fx.dictionary(spark, sf),
                                     fx.WEAPON_WORDS)


NEAREST_SQL = with_ctes(["weapon_points", "sites"], f"""
, pts AS (SELECT dr_no, CAST(lat AS FLOAT) AS lat, CAST(lon AS FLOAT) AS lon FROM weapon_points)
, dist AS (
  SELECT p.dr_no, trim(s.division) AS division, {haversine_sql('p.lat', 'p.lon', 's.site_lat', 's.site_lon')} AS d
  FROM pts p, sites s)
, nearest AS (
  SELECT dr_no, division, d FROM (
    SELECT *, rank() OVER (PARTITION BY dr_no ORDER BY d) AS rk FROM dist) r WHERE rk = 1)""")


@query("nearest_site", NEAREST_SQL + f"""
SELECT dr_no, division, {spark_round('d', 6)} AS distance_km FROM nearest""")
def q_nearest_site(spark, sf):
    near = analyses.nearest_site_per_incident(fx.incidents_with_codes(spark, sf), fx.dictionary(spark, sf),
                                              fx.sites(spark, sf), fx.WEAPON_WORDS)
    return near.select("dr_no", "division", F.round("distance_km", 6).alias("distance_km"))


@query("nearest_site_summary", NEAREST_SQL + f"""
SELECT division, {spark_round('avg(d)', 3)} AS avg_distance_km, count(*) AS count
FROM nearest GROUP BY division""")
def q_nearest_site_summary(spark, sf):
    return analyses.nearest_site_summary(fx.incidents_with_codes(spark, sf), fx.dictionary(spark, sf),
                                         fx.sites(spark, sf), fx.WEAPON_WORDS)


@query("haversine", with_ctes(["incidents", "sites"], f"""
SELECT i.dr_no, s.sid, {spark_round(haversine_sql('i.lat', 'i.lon', 's.site_lat', 's.site_lon'), 6)} AS distance_km
FROM incidents i
JOIN lineitem l ON l.l_orderkey = i.dr_no
JOIN sites s ON s.sid = l.l_suppkey
WHERE i.lat IS NOT NULL AND i.lon IS NOT NULL"""))
def q_haversine(spark, sf):
    # distance from each incident to every site that serves its order
    inc = fx.incidents_alone(spark, sf).filter(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    serves = fx.read(spark, sf, "lineitem", "l_orderkey", "l_suppkey")
    st = fx.sites(spark, sf)
    j = inc.join(serves, inc.dr_no == serves.l_orderkey).join(st, st.sid == serves.l_suppkey)
    return j.select("dr_no", "sid", F.round(fn.haversine_km("lat", "lon", "site_lat", "site_lon"), 6)
                    .alias("distance_km"))


# ------------------------------------------------------------ filters -------

@query("filter_required", with_ctes(["incidents"], """
SELECT dr_no, age, lat, lon FROM incidents WHERE age IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL"""))
def q_filter_required(spark, sf):
    return require(fx.incidents_alone(spark, sf), ["age", "lat", "lon"]).select("dr_no", "age", "lat", "lon")


@query("filter_regex", with_ctes(["incidents"], f"""
SELECT dr_no, crime FROM incidents WHERE regexp_matches(crime, '{fx.CRIME_PATTERN}')"""))
def q_filter_regex(spark, sf):
    return fx.incidents_alone(spark, sf).filter(fn.matches("crime", fx.CRIME_PATTERN)).select("dr_no", "crime")


@query("filter_null_island", with_ctes(["incidents"], """
SELECT dr_no, lat, lon FROM incidents WHERE NOT (lat = 0.0 AND lon = 0.0)"""))
def q_filter_null_island(spark, sf):
    return drop_null_island(fx.incidents_alone(spark, sf)).select("dr_no", "lat", "lon")


@query("filter_null_island_nullsafe", with_ctes(["incidents"], """
SELECT dr_no, lat, lon FROM incidents
WHERE NOT (lat IS NOT DISTINCT FROM 0.0 AND lon IS NOT DISTINCT FROM 0.0)"""))
def q_filter_null_island_nullsafe(spark, sf):
    return drop_null_island(fx.incidents_alone(spark, sf), null_safe=True).select("dr_no", "lat", "lon")


# ------------------------------------------------------- schema & sources ---

@query("trim_names", with_ctes(["incidents"], "SELECT * FROM incidents"))
def q_trim_names(spark, sf):
    return trim_names(fx.padded(fx.incidents(spark, sf)))


@query("union_eras", with_ctes(["incidents"], "SELECT * FROM incidents"))
def q_union_eras(spark, sf):
    first, second = fx.incident_eras(spark, sf)
    return union_eras(first, second)


@query("scan_parquet", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000""")
def q_scan_parquet(spark, sf):
    o = fx.read(spark, sf, "orders")
    return (o.filter((F.col("o_orderstatus") == "F") & (F.col("o_totalprice") > 100000))
            .select("o_orderkey", "o_custkey", "o_totalprice"))


@query("scan_csv", with_ctes(["incidents"], "SELECT * FROM incidents"))
def q_scan_csv(spark, sf):
    path = _csv_copy(spark, fx.incidents(spark, sf), "incidents-csv")
    return read_csv(spark, path, schema=schemas.INCIDENTS)


@query("scan_csv_by_name", with_ctes(["incidents"], "SELECT * FROM incidents"))
def q_scan_csv_by_name(spark, sf):
    # the file's columns are in another order, padded, and among others
    inc = fx.incidents(spark, sf)
    other = inc.select(*reversed(inc.columns), F.lit("x").alias("remark"))
    path = _csv_copy(spark, fx.padded(other), "incidents-reordered-csv")
    return read_csv(spark, path, schema=schemas.INCIDENTS)


@query("scan_csv_inferred", with_ctes(["census"], """
SELECT CAST(zip AS INTEGER) AS zip, round(CAST(hh AS DOUBLE), 1) AS hh FROM census"""))
def q_scan_csv_inferred(spark, sf):
    path = _csv_copy(spark, fx.census(spark, sf), "census-inferred-csv")
    return read_csv(spark, path, infer=True)


@query("code_dictionary", with_ctes(["code_lines"], """
SELECT code, description FROM (
  SELECT TRY_CAST(trim(CASE WHEN instr(value, ' ') > 0 THEN substr(value, 1, instr(value, ' ') - 1)
                            ELSE value END) AS INTEGER) AS code,
         CASE WHEN instr(value, ' ') > 0 THEN trim(substr(value, instr(value, ' ') + 1)) END AS description
  FROM code_lines WHERE value IS NOT NULL AND value <> '') t
WHERE code IS NOT NULL"""))
def q_code_dictionary(spark, sf):
    path = scratch_path(spark, "code-lines")
    write_text(fx.code_lines(spark, sf), path)
    return code_dictionary(read_text(spark, path))


@query("ingest_status", with_ctes(["incidents", "census", "income", "code_lines"], """
SELECT 'incidents' AS source, (SELECT count(*) FROM incidents) AS rows, true AS ok, CAST(NULL AS VARCHAR) AS error, false AS told
UNION ALL SELECT 'census', (SELECT count(*) FROM census), true, NULL, false
UNION ALL SELECT 'income', (SELECT count(*) FROM income), true, NULL, false
UNION ALL SELECT 'code_dictionary', (SELECT count(*) FROM code_lines WHERE value <> ''
     AND TRY_CAST(trim(CASE WHEN instr(value, ' ') > 0 THEN substr(value, 1, instr(value, ' ') - 1)
                       ELSE value END) AS INTEGER) IS NOT NULL), true, NULL, false
UNION ALL SELECT 'stations', NULL, false, 'PATH_NOT_FOUND', true"""))
def q_ingest_status(spark, sf):
    raw = scratch_path(spark, "raw")
    write_csv(fx.incidents(spark, sf), f"{raw}/incidents")
    write_csv(fx.census(spark, sf), f"{raw}/census")
    write_csv(fx.income(spark, sf), f"{raw}/income")
    write_text(fx.code_lines(spark, sf), f"{raw}/code_lines")
    catalogue = [
        Source("incidents", f"{raw}/incidents", "csv", schemas.INCIDENTS),
        Source("census", f"{raw}/census", "csv", schemas.CENSUS),
        Source("income", f"{raw}/income", "csv", schemas.INCOME),
        Source("code_dictionary", f"{raw}/code_lines", "text", transform=code_dictionary),
        Source("stations", f"{raw}/missing_stations", "csv", schemas.SITES),
    ]
    status = ingest(spark, catalogue, scratch_path(spark, "parquet"))
    # the message names this run's folder, so only its presence can be compared
    told = F.coalesce(F.col("message").contains("missing_stations"), F.lit(False))
    return status.select("source", "rows", "ok", "error", told.alias("told"))


@query("ingest_rejected", with_ctes(["census"], """
SELECT 'good' AS source, count(*) AS rows, 0 AS rejected, CAST(NULL AS VARCHAR) AS cells, 0 AS n FROM census
UNION ALL SELECT 'dirty', count(*) FILTER (CAST(zip AS INTEGER) % 7 <> 0), count(*) FILTER (CAST(zip AS INTEGER) % 7 = 0), 'hh',
  count(*) FILTER (CAST(zip AS INTEGER) % 7 = 0) FROM census"""))
def q_ingest_rejected(spark, sf):
    """Every seventh ZIP has a household size that is no number."""
    raw = scratch_path(spark, "raw")
    census = fx.census(spark, sf)
    write_csv(census, f"{raw}/good")
    dirty = F.when(F.col("zip").cast("int") % 7 == 0, F.concat(F.lit("about "), "hh")).otherwise(F.col("hh").cast("string"))
    write_csv(census.withColumn("hh", dirty), f"{raw}/dirty")
    out = scratch_path(spark, "parquet")
    status = ingest(spark, [Source(n, f"{raw}/{n}", "csv", schemas.CENSUS) for n in ("good", "dirty")], out)
    kept = read_parquet(spark, f"{out}/_rejected/dirty").where("hh like 'about %'").groupBy(F.lit("dirty").alias("source")).agg(
        F.max(F.array_join("_bad_cells", ",")).alias("cells"), F.count(F.lit(1)).alias("n"))
    return status.join(kept, "source", "left").select("source", "rows", "rejected", "cells", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


@query("scan_parquet_mixed", """
SELECT o_orderkey, o_totalprice, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderkey % 2 = 1 THEN o_custkey END AS o_custkey FROM orders""")
def q_scan_parquet_mixed(spark, sf):
    """Two eras of one table, each with a column that the other has not."""
    o, paths = fx.read(spark, sf, "orders"), [scratch_path(spark, "era") for _ in range(2)]
    write_parquet(o.where("o_orderkey % 2 = 0").select("o_orderkey", "o_totalprice", "o_orderstatus"), paths[0])
    write_parquet(o.where("o_orderkey % 2 = 1").select("o_custkey", "o_orderkey", "o_totalprice"), paths[1])
    return read_parquet(spark, paths).select("o_orderkey", "o_totalprice", "o_orderstatus", "o_custkey")


@query("union_type_drift", with_ctes(["incidents"], """
SELECT dr_no, CASE WHEN dr_no % 2 = 0 OR area % 5 <> 0 THEN area END AS area, CAST(age AS BIGINT) AS age FROM incidents"""))
def q_union_type_drift(spark, sf):
    """The area is a number in one era and text, at times no number, in the
    other; the age is of two number types."""
    inc = fx.incidents(spark, sf).select("dr_no", "area", "age")
    first = inc.where("dr_no % 2 = 0").withColumn("age", F.col("age").cast("bigint"))
    text = F.when(F.col("area") % 5 == 0, F.lit("n/a")).otherwise(F.col("area").cast("string"))
    return union_eras(first, inc.where("dr_no % 2 <> 0").withColumn("area", text), types="area int")


# -------------------------------------------------------------- sinks -------

@query("sink_parquet", with_ctes(["incidents"], "SELECT * FROM incidents"))
def q_sink_parquet(spark, sf):
    path = write_parquet(fx.incidents(spark, sf), scratch_path(spark, "incidents-parquet"))
    return spark.read.parquet(path)


@query("sink_csv", AGE_BANDS_SQL)
def q_sink_csv(spark, sf):
    bands = analyses.band_counts(fx.incidents_alone(spark, sf), "age", "crime", fx.CRIME_PATTERN)
    # the band table has at most four rows: one file is fine here
    path = write_csv(bands, scratch_path(spark, "age-bands-csv"), single_file=True)
    return read_csv(spark, path, schema="age_group string, count bigint")


@query("sink_ordered", with_ctes(["incidents"], """
SELECT row_number() OVER (ORDER BY age DESC NULLS LAST, dr_no) AS line, concat_ws(',', dr_no, coalesce(CAST(age AS VARCHAR), '')) AS value FROM incidents"""))
def q_sink_ordered(spark, sf):
    """Several part files, read back with line numbers."""
    rows = fx.incidents_alone(spark, sf).select("dr_no", "age")
    path = write_csv(rows, scratch_path(spark, "ordered"), header=False, order_by=[F.desc_nulls_last("age"), "dr_no"], parts=7)
    return read_numbered_lines(spark, path)


@query("sql_functions", with_ctes(["incidents", "sites"], f"""
SELECT i.dr_no, {BAND_SQL.format(a="i.age")} AS band, {YEAR_SQL.replace("date_occ", "i.date_occ")} AS year, lpad(CAST(i.dr_no % 1000 AS VARCHAR), 5, '0') AS zip,
       {spark_round(haversine_sql('i.lat', 'i.lon', 's.site_lat', 's.site_lon'), 6)} AS distance_km
FROM incidents i JOIN sites s ON s.sid = i.dr_no % 7 WHERE i.lat IS NOT NULL AND i.lon IS NOT NULL AND i.age IS NOT NULL"""))
def q_sql_functions(spark, sf):
    register_sql_functions(spark)
    return spark.sql("""
SELECT i.dr_no, age_band(i.age) AS band, incident_year(i.date_occ) AS year, zip5(CAST(i.dr_no % 1000 AS STRING)) AS zip,
       round(haversine_km(i.lat, i.lon, s.site_lat, s.site_lon), 6) AS distance_km
FROM {incidents} i JOIN {sites} s ON s.sid = i.dr_no % 7 WHERE i.lat IS NOT NULL AND i.lon IS NOT NULL AND i.age IS NOT NULL""",
                     incidents=fx.incidents_alone(spark, sf), sites=fx.sites(spark, sf))


@query("sink_csv_noheader", with_ctes(["income", "census"], f"""
SELECT i.zip, {_pp('i.v', 'c.hh')} AS income_per_person
FROM (SELECT zip, {CLEAN_FLOAT} AS v FROM income) i JOIN census c ON i.zip = c.zip"""))
def q_sink_csv_noheader(spark, sf):
    res = analyses.income_per_person(fx.income(spark, sf), fx.census(spark, sf), "none")
    path = write_csv(res, scratch_path(spark, "ipp-csv"), header=False)
    return read_csv(spark, path, schema="zip string, income_per_person double", header=False)


@query("sink_text", with_ctes(["income", "census"], f"""
SELECT coalesce(i.zip, '') || ',' || coalesce(printf('%.2f', {_pp('i.v', 'c.h')}), '') AS value
FROM (SELECT zip, {CLEAN_FLOAT} AS v FROM income) i
JOIN (SELECT zip, hh AS h FROM census) c ON i.zip = c.zip
WHERE i.v > 0 AND c.h > 0"""))
def q_sink_text(spark, sf):
    res = analyses.income_per_person(fx.income(spark, sf), fx.census(spark, sf), "positive")
    lines = res.select(fn.csv_line("zip", fn.fixed_decimals("income_per_person", 2)).alias("value"))
    path = write_text(lines, scratch_path(spark, "ipp-text"))
    return read_text(spark, path)


# ------------------------------------------------------------ sampling ------

@query("sample_rows", with_ctes(["incidents"], f"""
SELECT dr_no, status, crime FROM incidents
WHERE substr(md5(CAST(dr_no AS VARCHAR)), 1, 8) < '{int(0.05 * 2 ** 32):08x}'"""))
def q_sample_rows(spark, sf):
    return sample_by_key(fx.incidents_alone(spark, sf), "dr_no", 0.05).select("dr_no", "status", "crime")


@query("topk_rate_sampled", with_ctes(["incidents"], f"""
, agg AS (SELECT year, area, count(*) AS total, sum(closed) AS closed FROM (
    {Q2_BASE} AND substr(md5(CAST(dr_no AS VARCHAR)), 1, 8) < '{int(0.3 * 2 ** 32):08x}') b GROUP BY year, area)
SELECT * FROM (
  SELECT year, area, CAST(closed AS DOUBLE) / total * 100 AS closed_case_rate,
         CAST(dense_rank() OVER (PARTITION BY year ORDER BY CAST(closed AS DOUBLE) / total * 100 DESC) AS INTEGER) AS rank
  FROM agg) r
WHERE rank <= 3"""))
def q_topk_rate_sampled(spark, sf):
    return analyses.topk_rate(fx.incidents(spark, sf), "date_occ", "area", "status", fx.OPEN_STATUSES, sample=0.3)


def queries() -> dict[str, QueryFn]:
    _load_streaming()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_streaming()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}


def _load_streaming():
    from ..streaming import incremental  # noqa: F401  (registers its queries)


__all__ = ["REGISTRY", "queries", "oracle_sql", "query", "sql_list", "pad"]
