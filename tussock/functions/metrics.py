"""Housing metrics as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values (price plausibility bounds and flag labels) ---
PRICE_LOW = 200000
PRICE_HIGH = 5000000
FLAG_MISSING = "missing_price"
FLAG_LOW = "suspect_low"
FLAG_HIGH = "suspect_high"
FLAG_OK = "ok"
WEEKS_PER_YEAR = 52
# --- end of fixed values ---


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quality_flag(price: Column | str, low: float = PRICE_LOW, high: float = PRICE_HIGH) -> Column:
    """NULL -> missing_price, < low -> suspect_low, > high -> suspect_high, else ok.

    NaN counts as missing too: in Spark NaN sorts above every number, so a NaN
    price that slipped into a landing table would otherwise read as suspect_high.
    """
    p = _col(price)
    return (
        F.when(p.isNull() | F.isnan(p), FLAG_MISSING)
        .when(p < low, FLAG_LOW)
        .when(p > high, FLAG_HIGH)
        .otherwise(FLAG_OK)
    )


def price_is_ok(price: Column | str, low: float = PRICE_LOW, high: float = PRICE_HIGH) -> Column:
    """Same rows as ``quality_flag(price) == 'ok'`` but a plain range predicate,
    which parquet can use for row-group skipping (NaN fails ``<= high``)."""
    return _col(price).between(low, high)


def raw_ratio(price: Column | str, income: Column | str) -> Column:
    return _col(price) / F.nullif(_col(income), F.lit(0))


def price_to_income_ratio(price: Column | str, income: Column | str) -> Column:
    return F.round(raw_ratio(price, income), 2)


def affordability_index(price: Column | str, income: Column | str, swap_rate: Column | str) -> Column:
    """Rate-adjusted ratio from the UNROUNDED price-to-income ratio; higher = less affordable."""
    return F.round(raw_ratio(price, income) * (F.lit(1) + _col(swap_rate) / 100), 2)


def gross_yield_pct(weekly_rent: Column | str, price: Column | str) -> Column:
    """weekly rent x 52 / price x 100."""
    return _col(weekly_rent) * WEEKS_PER_YEAR / F.nullif(_col(price), F.lit(0)) * 100
