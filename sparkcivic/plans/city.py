"""The four questions and the preparation job on the city data sets' own
column layout: crime extracts (two eras), police stations, income by ZIP,
census by ZIP and the MO-code text list.

Each function only binds column names and fixed values to the generic
analyses, so a job on those files is a few calls::

    crime = read_crime(spark, [p_2010, p_2020])
    age_bands(crime).write.csv(out)
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import first_present_column, union_eras  # noqa: F401  (union_eras re-exported)
from ..sources import Source, code_dictionary, ingest, read_csv, read_parquet
from ..sources.schemas import CRIME
from . import analyses

# Fixed values of the city analyses.
ASSAULT_PATTERN = "(?i)aggravated assault"
OPEN_CASE_STATUSES = ("UNK", "Invest Cont")
WEAPON_WORDS = ("gun", "weapon")
TOP_K = 3

# Column names of the city files (as written in their headers).
DR_NO, DATE_OCC, AREA_NAME, STATUS_DESC = "DR_NO", "DATE OCC", "AREA NAME", "Status Desc"
CRIME_DESC, VICTIM_AGE, MO_CODES, LAT, LON = "Crm Cd Desc", "Vict Age", "Mocodes", "LAT", "LON"
ZIP_NAMES = ("Zip Code", "ZipCode", "zip_code")
INCOME_NAMES = ("Estimated Median Income", "Income")
HOUSEHOLD_NAMES = ("Average Household Size", "average_household_size")
CODES = "MO_Code int, Description string"


def read_crime(spark: SparkSession, paths: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """Both eras, names trimmed, unioned by name. CSV input uses the declared schema."""
    if fmt == "csv":
        frames = [read_csv(spark, p, schema=CRIME) for p in paths]
    else:
        frames = [read_parquet(spark, p) for p in paths]
    return union_eras(*frames)


def prepare(spark: SparkSession, raw: dict[str, str], out_root: str) -> DataFrame:
    """CSV/text sources to Parquet; returns the per-source status table.

    ``raw`` maps source names (crime_2010_2019, crime_2020_present,
    la_police_stations, la_income_2015, census_2010_zipcode, mo_codes) to paths.
    """
    catalogue = []
    for name, path in raw.items():
        if name == "mo_codes":
            catalogue.append(Source(name, path, "text", transform=mo_codes))
        elif name.startswith("crime"):
            catalogue.append(Source(name, path, "csv", CRIME))
        else:
            catalogue.append(Source(name, path, "csv"))  # small tables: schema inferred
    return ingest(spark, catalogue, out_root)


def mo_codes(lines: DataFrame) -> DataFrame:
    """The raw text list as the table of codes."""
    d = code_dictionary(lines)
    return d.select(F.col("code").alias("MO_Code"), F.col("description").alias("Description"))


def age_bands(crime: DataFrame, how: str = "native") -> DataFrame:
    """Victims of aggravated assault per age band (``how="udf"`` for the UDF twin)."""
    return analyses.band_counts(crime, VICTIM_AGE, CRIME_DESC, ASSAULT_PATTERN, how=how, group_col="AgeGroup")


def top_areas(crime: DataFrame, variant: str = "dataframe") -> DataFrame:
    """Top-3 areas per year by closed-case rate.

    ``dataframe``: dense ranks, timestamp year, NULL-year group kept.
    ``sql``: row numbers through ``spark.sql`` with an exact decimal rate.
    ``rdd``: row numbers, year from the text, NULL years dropped, empty text
    rejected, only the exact (0, 0) location dropped.
    """
    if variant == "sql":
        renamed = crime.withColumnRenamed(LAT, "lat").withColumnRenamed(LON, "lon")
        return analyses.topk_rate_sql(crime.sparkSession, renamed, DATE_OCC, AREA_NAME, STATUS_DESC,
                                      OPEN_CASE_STATUSES, TOP_K)
    opts = dict(lat=LAT, lon=LON, k=TOP_K)
    if variant == "rdd":
        opts.update(ties="row", year_from="text", null_safe_island=True, keep_null_year=False,
                    non_empty_text=True)
    elif variant != "dataframe":
        raise ValueError("variant must be 'dataframe', 'sql' or 'rdd'")
    return analyses.topk_rate(crime, DATE_OCC, AREA_NAME, STATUS_DESC, OPEN_CASE_STATUSES, **opts)


def _required(df: DataFrame, names: Sequence[str]):
    if not any(n in df.columns for n in names):
        raise ValueError(f"none of the columns {', '.join(names)}")
    return first_present_column(df, names)


def income_per_person(income: DataFrame, census: DataFrame, mode: str = "positive") -> DataFrame:
    """Income per person by ZIP; the first present of the known column names is
    used, and a table that has none of them is an error."""
    inc = income.select(_required(income, ZIP_NAMES).alias("zip"),
                        _required(income, INCOME_NAMES).cast("string").alias("inc"))
    pop = census.select(_required(census, ZIP_NAMES).alias("zip"), _required(census, HOUSEHOLD_NAMES).alias("hh"))
    return analyses.income_per_person(inc, pop, mode)


def nearest_station(crime: DataFrame, mo_codes: DataFrame, stations: DataFrame) -> DataFrame:
    """Per station: incidents with a weapon MO code whose nearest station it
    is, and their mean distance in km (X is longitude, Y latitude)."""
    inc = crime.select(F.col(DR_NO).alias("dr_no"), F.col(MO_CODES).alias("mocodes"),
                       F.col(LAT).alias("lat"), F.col(LON).alias("lon"))
    dic = mo_codes.select(F.col("MO_Code").alias("code"), F.col("Description").alias("description"))
    st = stations.select(F.col("DIVISION").alias("division"), F.col("Y").try_cast("double").alias("site_lat"),
                         F.col("X").try_cast("double").alias("site_lon"))
    return analyses.nearest_site_summary(inc, dic, st, WEAPON_WORDS)
