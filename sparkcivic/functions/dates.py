"""Year extraction from date text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the date-time layout of the incident date field.
INCIDENT_TS_FORMAT = "MM/dd/yyyy hh:mm:ss a"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_year(c, fmt: str = INCIDENT_TS_FORMAT) -> Column:
    """Year of a timestamp written as text; NULL when the text does not parse
    (``try_to_timestamp`` keeps ANSI mode from raising on dirty rows)."""
    return F.year(F.try_to_timestamp(_c(c), F.lit(fmt)))


def parse_year_text(c, sep: str = "/", position: int = 2) -> Column:
    """Year taken from the text itself: third '/'-separated field, first four
    characters, as int; NULL when any step fails. Does not validate the date."""
    part = F.get(F.split(_c(c), sep), position)
    return F.substring(part, 1, 4).try_cast("int")
