"""Pure Column functions (no DataFrame in, no DataFrame out)."""

from .bands import AGE_BANDS, AGE_OTHERWISE, UNKNOWN, band, band_safe, band_udf
from .dates import INCIDENT_TS_FORMAT, parse_year, parse_year_text
from .geo import EARTH_RADIUS_KM, haversine_km, not_null_island
from .report import csv_line, fixed_decimals, rank_label
from .text import (clean_money, clean_money_positive, contains_any, matches, non_empty,
                   split_codes, zip_pad)

__all__ = [
    "AGE_BANDS", "AGE_OTHERWISE", "UNKNOWN", "band", "band_safe", "band_udf",
    "INCIDENT_TS_FORMAT", "parse_year", "parse_year_text",
    "EARTH_RADIUS_KM", "haversine_km", "not_null_island",
    "csv_line", "fixed_decimals", "rank_label",
    "clean_money", "clean_money_positive", "contains_any", "matches", "non_empty",
    "split_codes", "zip_pad",
]
