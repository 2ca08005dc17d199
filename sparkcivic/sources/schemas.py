"""Declared schemas: CSV input is never type-inferred unless asked for."""

from __future__ import annotations

from pyspark.sql.types import (DoubleType, FloatType, IntegerType, LongType, StringType,
                               StructField, StructType)


def _s(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


# Column layout of the public city crime extracts (both eras),
# in file order. Codes and ages stay text where the files carry dirty values.
CRIME = _s(
    ("DR_NO", LongType()), ("Date Rptd", StringType()), ("DATE OCC", StringType()),
    ("TIME OCC", IntegerType()), ("AREA", IntegerType()), ("AREA NAME", StringType()),
    ("Rpt Dist No", IntegerType()), ("Part 1-2", IntegerType()), ("Crm Cd", IntegerType()),
    ("Crm Cd Desc", StringType()), ("Mocodes", StringType()), ("Vict Age", IntegerType()),
    ("Vict Sex", StringType()), ("Vict Descent", StringType()), ("Premis Cd", IntegerType()),
    ("Premis Desc", StringType()), ("Weapon Used Cd", IntegerType()), ("Weapon Desc", StringType()),
    ("Status", StringType()), ("Status Desc", StringType()), ("Crm Cd 1", IntegerType()),
    ("Crm Cd 2", IntegerType()), ("Crm Cd 3", IntegerType()), ("Crm Cd 4", IntegerType()),
    ("LOCATION", StringType()), ("Cross Street", StringType()), ("LAT", DoubleType()),
    ("LON", DoubleType()),
)

# Our fixture tables (derived from the driver tables, see plans.fixtures).
INCIDENTS = _s(
    ("dr_no", LongType()), ("area", IntegerType()), ("status", StringType()),
    ("crime", StringType()), ("age", IntegerType()), ("date_occ", StringType()),
    ("lat", DoubleType()), ("lon", DoubleType()),
)
SITES = _s(("sid", LongType()), ("division", StringType()), ("site_lat", FloatType()),
           ("site_lon", FloatType()))
CENSUS = _s(("zip", StringType()), ("hh", FloatType()))
INCOME = _s(("zip", StringType()), ("inc", StringType()))
