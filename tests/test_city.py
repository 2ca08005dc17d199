"""The city-layout bindings on a few hand-written rows with the real column names."""

import pytest

from sparkcivic.plans import city

CRIME_DDL = ("DR_NO long, `DATE OCC` string, `AREA NAME` string, `Status Desc` string, "
             "`Crm Cd Desc` string, `Vict Age` int, Mocodes string, LAT double, LON double")
ROWS = [
    (1, "01/08/2020 12:00:00 AM", "Central", "Adult Arrest", "ASSAULT WITH DEADLY WEAPON, AGGRAVATED ASSAULT", 30,
     "0400 1100", 34.05, -118.25),
    (2, "02/09/2020 11:00:00 PM", "Central", "Invest Cont", "aggravated assault", 16, "0913", 34.06, -118.24),
    (3, "03/10/2021 01:00:00 PM", "Harbor", "UNK", "BURGLARY", 70, None, 0.0, 0.0),
    (4, "garbage", "Harbor", "Adult Other", "AGGRAVATED ASSAULT", 80, "0400", 33.74, -118.28),
]


@pytest.fixture(scope="module")
def crime(spark):
    a = spark.createDataFrame(ROWS[:2], CRIME_DDL)
    b = spark.createDataFrame(ROWS[2:], CRIME_DDL)
    b = b.toDF(*[f" {c} " for c in b.columns])  # padded names in the second era
    return city.union_eras(a, b)


def test_age_bands_native_and_udf(crime):
    want = {("Adults", 1), ("Children", 1), ("Elderly", 1)}
    assert {tuple(r) for r in city.age_bands(crime).collect()} == want
    assert {tuple(r) for r in city.age_bands(crime, how="udf").collect()} == want


def test_top_areas_variants(crime):
    dense = [tuple(r) for r in city.top_areas(crime).collect()]
    assert dense == [(None, "Harbor", 100.0, 1), (2020, "Central", 50.0, 1)]
    sql = [tuple(r) for r in city.top_areas(crime, "sql").collect()]
    assert sql == [(None, "Harbor", 100.0, 1), (2020, "Central", 50.0, 1)]
    rdd = [tuple(r) for r in city.top_areas(crime, "rdd").collect()]
    assert rdd == [(2020, "Central", 50.0, 1)]


def test_income_per_person_with_alternative_names(spark):
    income = spark.createDataFrame([(90001, "$30,000"), (90002, "-")], "`Zip Code` int, `Estimated Median Income` string")
    census = spark.createDataFrame([(90001, 3.0), (90002, 2.0)], "zip_code int, average_household_size double")
    assert [tuple(r) for r in city.income_per_person(income, census).collect()] == [("90001", 10000.0)]


def test_nearest_station(spark, crime):
    mo = spark.createDataFrame([(400, "Strong-arm (hands, fist, feet)"), (1100, "Hand gun"), (913, "Weapon: knife")],
                               "MO_Code int, Description string")
    stations = spark.createDataFrame([(" CENTRAL ", -118.25, 34.05), ("HARBOR", -118.29, 33.75)],
                                     "DIVISION string, X double, Y double")
    got = {r.division: (r["count"], r.avg_distance_km) for r in city.nearest_station(crime, mo, stations).collect()}
    assert set(got) == {"CENTRAL"} and got["CENTRAL"][0] == 2
