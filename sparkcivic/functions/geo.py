"""Great-circle distance and coordinate sanity predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in kilometres used for all distances.
EARTH_RADIUS_KM = 6371.0


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine_km(lat1, lon1, lat2, lon2, radius: float = EARTH_RADIUS_KM) -> Column:
    """Haversine distance in km between two points given in degrees.

    ``a`` is clamped to [0, 1] so rounding near antipodal points cannot
    produce NaN through ``sqrt(1 - a)``.
    """
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    l1, l2 = F.radians(_c(lon1)), F.radians(_c(lon2))
    dlat = p2 - p1
    dlon = l2 - l1
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    # CASE rather than least/greatest: those skip NULLs and would turn a
    # missing coordinate into distance 0
    a = F.when(a > 1.0, F.lit(1.0)).when(a < 0.0, F.lit(0.0)).otherwise(a)
    return F.lit(radius) * (F.lit(2.0) * F.atan2(F.sqrt(a), F.sqrt(F.lit(1.0) - a)))


def not_null_island(lat, lon, null_safe: bool = False) -> Column:
    """Keep-predicate that rejects the (0, 0) placeholder location.

    ``null_safe=False`` is SQL three-valued logic: a row with a NULL
    coordinate where the other is 0 or NULL also fails the filter.
    ``null_safe=True`` rejects exactly (0, 0) and keeps rows with NULLs.
    """
    lat, lon = _c(lat), _c(lon)
    if null_safe:
        return ~(lat.eqNullSafe(0.0) & lon.eqNullSafe(0.0))
    return ~((lat == 0.0) & (lon == 0.0))
