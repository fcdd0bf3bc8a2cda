"""Great-circle distance as a built-in expression (no UDF)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine_km(lat1, lon1, lat2, lon2, radius_km: float = EARTH_RADIUS_KM) -> Column:
    """2R asin(sqrt(sin^2(dphi/2) + cos phi1 cos phi2 sin^2(dlambda/2)))."""
    p1, p2 = F.radians(_col(lat1)), F.radians(_col(lat2))
    dphi = p2 - p1
    dlam = F.radians(_col(lon2)) - F.radians(_col(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlam / 2), 2)
    return F.lit(2 * radius_km) * F.asin(F.sqrt(a))


def band_height_deg(radius_km: float, earth_km: float = EARTH_RADIUS_KM) -> float:
    """Latitude band height such that two points closer than ``radius_km`` are at
    most one band apart: great-circle distance >= R * |dphi|."""
    return math.degrees(radius_km / earth_km) * (1.0 + 1e-9)


def lon_cell_width_deg(band: Column, height_deg: float, radius_km: float, earth_km: float = EARTH_RADIUS_KM) -> Column:
    """Longitude cell width for a latitude band, wide enough that any pair closer
    than ``radius_km`` with the stop in this band and the centre in this or a
    neighbouring band is at most one cell apart.

    From hav(d/R) >= cos(phi1) cos(phi2) hav(dlambda): with phi_m the largest
    |latitude| reachable (band +- one band), dlambda < 2 asin(sqrt(hav(r/R)) / cos(phi_m)).
    Near the poles the bound exceeds 180 degrees and the band becomes one cell.
    """
    lo = (band - 1) * height_deg - 90.0
    hi = (band + 2) * height_deg - 90.0
    phi_m = F.least(F.greatest(F.abs(lo), F.abs(hi)), F.lit(90.0))
    s = math.sin(radius_km / earth_km / 2.0)
    ratio = F.lit(s) / F.cos(F.radians(phi_m))
    width = F.when(ratio >= 1.0, F.lit(360.0)).otherwise(F.degrees(2 * F.asin(ratio)) * (1.0 + 1e-9))
    return F.least(width, F.lit(360.0))
