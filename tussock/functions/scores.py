"""Bounded 0-10 scores and the weighted liveability composite."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values (score scales and composite weights) ---
SCORE_CAP = 10
EQI_FLOOR = 344
EQI_STEP = 22.5
SUPERMARKET_POINTS = Decimal("2.0")
STOPS_PER_POINT = Decimal("3.0")
WEIGHT_TRANSIT = 0.45
WEIGHT_SCHOOL = 0.40
WEIGHT_AMENITY = 0.15
WALK_RADIUS_KM = 0.8
# --- end of fixed values ---


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clamp_scale(x: Column | str, floor: float = 0.0, step: float = 1.0, cap: float = SCORE_CAP) -> Column:
    """least(greatest(x - floor, 0) / step, cap), NULL when x is NULL.

    Spark's least/greatest skip NULL arguments, so NULL is restored explicitly.
    """
    x = _col(x)
    v = F.least(F.greatest(x - F.lit(floor), F.lit(0.0)) / F.lit(step), F.lit(float(cap)))
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(v)


def school_score(avg_eqi: Column | str) -> Column:
    return F.round(clamp_scale(avg_eqi, EQI_FLOOR, EQI_STEP, SCORE_CAP), 2)


def amenity_score(supermarket_count: Column | str) -> Column:
    """least(count * 2.0, 10) in exact decimal arithmetic, returned as double."""
    return F.least(_col(supermarket_count) * F.lit(SUPERMARKET_POINTS), F.lit(SCORE_CAP)).cast("double")


def transit_score(stop_count: Column | str) -> Column:
    """least(count / 3.0, 10) in decimal arithmetic (six decimals), returned as double."""
    return F.least(_col(stop_count) / F.lit(STOPS_PER_POINT), F.lit(SCORE_CAP)).cast("double")


def liveability_score(transit: Column | str, school: Column | str, amenity: Column | str) -> Column:
    """Weighted composite; a missing component counts as 0."""
    return F.round(
        F.coalesce(_col(transit), F.lit(0.0)) * WEIGHT_TRANSIT
        + F.coalesce(_col(school), F.lit(0.0)) * WEIGHT_SCHOOL
        + F.coalesce(_col(amenity), F.lit(0.0)) * WEIGHT_AMENITY,
        2,
    )
