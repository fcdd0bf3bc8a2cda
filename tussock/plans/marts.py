"""Marts: affordability (suburb x month) and liveability (suburb).

Plan shape (affordability): prices are filtered to plausible values at the
scan, reduced to (suburb, month) with partial + final aggregation, then
left-joined to four one-row-per-key dimensions (themselves aggregates).
No raw price row crosses a join: the fact side is already the (suburb, month)
aggregate. The dimension joins are plain equi-joins; adaptive execution
measures each dimension's materialised size and broadcasts it only when it is
below ``spark.sql.adaptive.autoBroadcastJoinThreshold``, otherwise the join
stays a sort-merge join with skew splitting. The suburb key expression is
computed once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tussock.functions.metrics import affordability_index, price_is_ok, price_to_income_ratio
from tussock.functions.names import suburb_key
from tussock.functions.scores import (
    WALK_RADIUS_KM, amenity_score, liveability_score, school_score, transit_score,
)
from tussock.operators.spatial import count_within_distance
from tussock.plans import staging as stg

AFFORDABILITY_COLUMNS = [
    "suburb", "report_date", "avg_sale_price", "avg_weekly_rent", "gross_yield_pct",
    "median_household_income", "ocr_rate", "swap_rate_2yr", "school_count", "avg_eqi_index",
    "supermarket_count", "price_to_income_ratio", "affordability_index",
]


def rounded_mean(col: str, decimals: int, scale: int = 6) -> F.Column:
    """Rounded mean whose sum is exact (DECIMAL with ``scale`` places, more than the measure
    has): a sum of doubles depends, in its last bits, on the order of the tasks, which shows
    where the mean lies on a half."""
    return F.round(F.avg(F.col(col).cast(f"decimal(38,{scale})")), decimals).cast("double").alias(col)


def property_by_suburb_month(prices_stg: DataFrame) -> DataFrame:
    """'ok' prices averaged to (suburb, month); district-level rows weigh equally."""
    ok = prices_stg.filter(price_is_ok(F.col("avg_sale_price")))
    return ok.groupBy("suburb", "report_month").agg(
        F.max("report_date").alias("report_date"),
        rounded_mean("avg_sale_price", 0),
        rounded_mean("avg_weekly_rent", 0),
        rounded_mean("gross_yield_pct", 2, 12),
        F.min("data_quality_flag").alias("data_quality_flag"),
    )


def report_dates(prices_stg: DataFrame) -> DataFrame:
    """Report dates of the price rows that reach the mart: its latest date without its joins."""
    return prices_stg.filter(price_is_ok(F.col("avg_sale_price"))).select("report_date")


def school_summary(schools_stg: DataFrame) -> DataFrame:
    return schools_stg.groupBy("suburb").agg(
        F.count(F.lit(1)).alias("school_count"),
        F.round(F.avg("eqi_index"), 1).alias("avg_eqi_index"),
    )


def supermarket_summary(supermarkets_stg: DataFrame) -> DataFrame:
    return supermarkets_stg.groupBy("suburb").agg(F.count(F.lit(1)).alias("supermarket_count"))


def affordability_mart(landing: stg.Landing, schools_stg: DataFrame | None = None) -> DataFrame:
    if schools_stg is None:
        schools_stg = stg.stg_schools(landing.schools)
    prop = property_by_suburb_month(stg.stg_prices(landing.prices))
    prop = prop.withColumn("_key", suburb_key(F.col("suburb")))

    census = stg.stg_census_income(landing.census).select(
        F.col("suburb").alias("_key"), "median_household_income")
    rates = stg.stg_rates(landing.rates).select(
        F.col("rate_month").alias("report_month"), "ocr_rate", "swap_rate_2yr")
    schools = school_summary(schools_stg).withColumnRenamed("suburb", "_key")
    amenity = supermarket_summary(stg.stg_supermarkets(landing.supermarkets)).withColumnRenamed("suburb", "_key")

    j = (
        prop.join(census, "_key", "left")
        .join(rates, "report_month", "left")
        .join(schools, "_key", "left")
        .join(amenity, "_key", "left")
    )
    return j.select(
        "suburb", "report_date", "avg_sale_price", "avg_weekly_rent", "gross_yield_pct",
        "median_household_income", "ocr_rate", "swap_rate_2yr", "school_count", "avg_eqi_index",
        "supermarket_count",
        price_to_income_ratio(F.col("avg_sale_price"), F.col("median_household_income")).alias("price_to_income_ratio"),
        affordability_index(F.col("avg_sale_price"), F.col("median_household_income"),
                            F.col("swap_rate_2yr")).alias("affordability_index"),
    )


# ------------------------------------------------------------ liveability ---

def school_scores(schools_stg: DataFrame) -> DataFrame:
    return schools_stg.groupBy("suburb").agg(
        F.count(F.lit(1)).alias("school_count"),
        F.round(F.avg("eqi_index"), 2).alias("avg_eqi_index"),
        school_score(F.avg("eqi_index")).alias("school_score"),
    )


def amenity_scores(supermarkets_stg: DataFrame) -> DataFrame:
    return supermarkets_stg.groupBy("suburb").agg(
        F.count(F.lit(1)).alias("supermarket_count"),
        amenity_score(F.count(F.lit(1))).alias("amenity_score"),
    )


def transit_scores(centroids: DataFrame, stops_stg: DataFrame, radius_km: float = WALK_RADIUS_KM) -> DataFrame:
    counts = count_within_distance(
        centroids, stops_stg, radius_km, centre_key="suburb", point_id="stop_id", out_col="transit_stops_800m")
    return counts.select("suburb", "transit_stops_800m", transit_score(F.col("transit_stops_800m")).alias("transit_score"))


def liveability_mart(landing: stg.Landing, schools_stg: DataFrame | None = None) -> DataFrame:
    if schools_stg is None:
        schools_stg = stg.stg_schools(landing.schools)
    centroids = stg.suburb_centroids(schools_stg)
    transit = transit_scores(centroids, stg.stg_stops(landing.stops))
    schools = school_scores(schools_stg)
    amenity = amenity_scores(stg.stg_supermarkets(landing.supermarkets))
    c = centroids.select("suburb", "centroid_lat", "centroid_lon")
    j = (
        c.join(transit, "suburb", "left")
        .join(schools, "suburb", "left")
        .join(amenity, "suburb", "left")
    )
    return j.select(
        "suburb", "centroid_lat", "centroid_lon", "transit_stops_800m", "transit_score",
        "school_count", "avg_eqi_index", "school_score", "supermarket_count", "amenity_score",
        liveability_score(F.col("transit_score"), F.col("school_score"), F.col("amenity_score")).alias("liveability_score"),
    )
