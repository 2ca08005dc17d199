"""The library's column functions under names that SQL text can call.

They are SQL functions of the session: Catalyst puts their bodies in the place
of the call, so a query that calls them has the plan of one that spells them
out, with pushdown and code generation. Bodies are built from the same fixed
values as the column functions.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .bands import AGE_BANDS, AGE_OTHERWISE, UNKNOWN
from .dates import INCIDENT_TS_FORMAT
from .geo import EARTH_RADIUS_KM


def _text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _band(c: str) -> str:
    cases = " ".join(f"WHEN {c} {op} {bound} THEN {_text(label)}" for label, op, bound in AGE_BANDS)
    return f"CASE {cases} WHEN {c} IS NOT NULL THEN {_text(AGE_OTHERWISE)} END"


_A = ("pow(sin((radians(lat2) - radians(lat1)) / 2), 2) + cos(radians(lat1)) * cos(radians(lat2)) "
      "* pow(sin((radians(lon2) - radians(lon1)) / 2), 2)")
_MONEY = "try_cast(translate(trim(t), '$,', '') AS DOUBLE)"

#: name -> (parameters, result type, body)
FUNCTIONS: dict[str, tuple[str, str, str]] = {
    "age_band": ("age BIGINT", "STRING", _band("age")),
    "age_band_safe": ("age STRING", "STRING", f"coalesce({_band('try_cast(age AS BIGINT)')}, {_text(UNKNOWN)})"),
    "incident_year": ("t STRING", "INT", f"year(try_to_timestamp(t, {_text(INCIDENT_TS_FORMAT)}))"),
    "incident_year_text": ("t STRING", "INT", "try_cast(substring(get(split(t, '/'), 2), 1, 4) AS INT)"),
    "money": ("t STRING", "FLOAT", "try_cast(translate(t, '$,', '') AS FLOAT)"),
    "money_positive": ("t STRING", "DOUBLE", f"CASE WHEN {_MONEY} > 0 AND NOT isnan({_MONEY}) AND {_MONEY} <> double('inf') THEN {_MONEY} END"),
    "zip5": ("t STRING", "STRING", "CASE WHEN length(t) >= 5 THEN t WHEN left(t, 1) IN ('+', '-') THEN concat(left(t, 1), "
             "lpad(substring(t, 2), 4, '0')) ELSE lpad(t, 5, '0') END"),
    "haversine_km": ("lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE", "DOUBLE",
                     f"CAST({EARTH_RADIUS_KM!r} AS DOUBLE) * 2 * atan2(sqrt(CASE WHEN {_A} > 1 THEN 1D ELSE {_A} END), "
                     f"sqrt(1D - CASE WHEN {_A} > 1 THEN 1D ELSE {_A} END))"),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Make :data:`FUNCTIONS` callable in the session's SQL; returns their names."""
    for name, (parameters, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    return list(FUNCTIONS)
