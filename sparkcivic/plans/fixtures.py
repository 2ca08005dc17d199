"""Bindings of the analyses' input tables onto the driver's TPC-H-style tables.

Each function reads the parquet tables under ``sf_dir`` and derives the
table an analysis expects (incidents, sites, census, income, code lists,
code-dictionary text lines). Dirty values (NULLs, the (0, 0) location,
unparsable dates, non-numeric money) are injected by key arithmetic so the
same rows are dirty in every engine. ``plans.oracle`` holds the DuckDB twins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import INCIDENT_TS_FORMAT
from ..functions.text import zip_pad
from ..session import table_path

# Fixed values of the bindings.
OPEN_STATUSES = ("O", "P")            # statuses of cases that are still open
CRIME_PATTERN = "(?i)urgent"         # incident type searched by the band counts
CRIME_WORD = "urgent"
WEAPON_WORDS = ("hot", "red")        # dictionary words that mark a weapon code
ERA_SPLIT = "1998-01-01"             # first day of the second era
JUNK_CODE_LINES = ("", "0400", "abc def", " 12 x")
CODE_STEPS = (611953, 746773, 882377, 1299709)  # one multiplier per code slot


def read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*cols) if cols else df


def _incident_columns(k, area: bool):
    return [
        F.col("o_orderkey").alias("dr_no"),
        *([F.col("c_nationkey").alias("area")] if area else []),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("crime"),
        F.when(k % 17 == 0, F.lit(None)).otherwise(
            F.floor(F.col("o_totalprice") / 5000).cast("int") - 1).alias("age"),
        F.when(k % 101 == 0, F.lit("garbage")).otherwise(
            F.date_format("o_orderdate", INCIDENT_TS_FORMAT)).alias("date_occ"),
        F.when(k % 7 == 0, F.lit(0.0)).when(k % 11 == 0, F.lit(None)).otherwise(
            F.lit(33.7) + (k * 7919) % 5000 / F.lit(10000.0)).alias("lat"),
        F.when(k % 7 == 0, F.lit(0.0)).when(k % 13 == 0, F.lit(None)).otherwise(
            F.lit(-118.7) + (k * 3571) % 6000 / F.lit(10000.0)).alias("lon"),
    ]


def incidents_with_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
             "o_orderpriority", "o_totalprice", "o_orderdate")
    c = read(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    k = F.col("o_orderkey")
    return o.join(c, o.o_custkey == c.c_custkey).select(*_incident_columns(k, True), "o_orderdate")


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dr_no, area, status, crime, age, date_occ, lat, lon (one row per order)."""
    return incidents_with_date(spark, sf_dir).drop("o_orderdate")


def incidents_alone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incidents without their area, which needs no join."""
    o = read(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderdate")
    return o.select(*_incident_columns(F.col("o_orderkey"), False))


def padded(df: DataFrame) -> DataFrame:
    """The same columns under names with blanks around them."""
    return df.toDF(*[f" {c}" if i % 2 == 0 else f"{c}  " for i, c in enumerate(df.columns)])


def incident_eras(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The incidents split in two eras; the second era carries padded column
    names, as one of the real extracts does."""
    both = incidents_with_date(spark, sf_dir)
    first = both.filter(F.col("o_orderdate") < F.lit(ERA_SPLIT).cast("timestamp")).drop("o_orderdate")
    second = both.filter(F.col("o_orderdate") >= F.lit(ERA_SPLIT).cast("timestamp")).drop("o_orderdate")
    return first, padded(second)


def mocodes(k, parts: Column) -> Column:
    """Code-list text of an incident, derived from its key: one to four 6-digit
    codes from 1..``parts``, space separated; NULL for one key in 19. A per-row
    expression, so no order's codes are gathered through a shuffle."""
    n = k % len(CODE_STEPS) + 1
    codes = [F.when(n > i, zip_pad(k * step % parts + 1, 6)) for i, step in enumerate(CODE_STEPS)]
    return F.when(k % 19 != 0, F.concat_ws(" ", *codes))


def incidents_with_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The incidents (without area) plus ``mocodes``, the code-list text, whose
    codes reach over all part keys."""
    parts = read(spark, sf_dir, "part", "p_partkey").agg(F.max("p_partkey")).scalar()
    return incidents_alone(spark, sf_dir).withColumn("mocodes", mocodes(F.col("dr_no"), parts))


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sid, division, site_lat, site_lon (float32, like the station extract)."""
    k = F.col("s_suppkey")
    return read(spark, sf_dir, "supplier", "s_suppkey", "s_name").select(
        k.alias("sid"), F.col("s_name").alias("division"),
        (F.lit(33.7) + (k * 6151) % 5000 / F.lit(10000.0)).cast("float").alias("site_lat"),
        (F.lit(-118.7) + (k * 104729) % 6000 / F.lit(10000.0)).cast("float").alias("site_lon"))


def census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """zip (text), hh = average household size (float, 0.0 .. 19.9)."""
    k = F.col("c_custkey")
    return read(spark, sf_dir, "customer", "c_custkey").select(
        zip_pad(k, 5).alias("zip"), ((k % 200).cast("double") / F.lit(10.0)).cast("float").alias("hh"))


def income(spark: SparkSession, sf_dir: str) -> DataFrame:
    """zip, inc: money as text like '$12,345' ('-' when unknown); a third of the
    rows have a ZIP that the census does not know."""
    k = F.col("c_custkey")
    money = F.concat(F.lit("$"), F.format_number(F.floor(F.col("c_acctbal") * 10), 0))
    return (read(spark, sf_dir, "customer", "c_custkey", "c_acctbal")
            .select(zip_pad(F.when(k % 3 != 0, k).otherwise(-k - 1), 5).alias("zip"),
                    F.when(k % 29 == 0, F.lit("-")).otherwise(money).alias("inc")))


def dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """code, description."""
    return read(spark, sf_dir, "part", "p_partkey", "p_name").select(
        F.col("p_partkey").cast("int").alias("code"), F.col("p_name").alias("description"))


def code_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """value: 'CODE description' text lines plus a few malformed lines."""
    lines = read(spark, sf_dir, "part", "p_partkey", "p_name").select(
        F.concat(zip_pad(F.col("p_partkey"), 6), F.lit(" "), F.col("p_name")).alias("value"))
    junk = spark.createDataFrame([(v,) for v in JUNK_CODE_LINES], "value string")
    return lines.unionByName(junk)
