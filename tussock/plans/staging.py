"""Staging transforms: typed, flagged, normalised views over landing frames.

Each function is ``landing DataFrame -> DataFrame`` and uses a single
``select`` so that a column alias never shadows the source column it reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tussock.functions.cleaning import coerce_double, landing_date, month_key, try_int
from tussock.functions.metrics import quality_flag
from tussock.functions.names import canonical_supermarket_suburb, parent_suburb, plain_suburb

# --- Fixed values (census metric selector, centroid bounding box, stop types) ---
INCOME_METRIC = "Median household income"
INCOME_STATISTIC = "Median"
CENTROID_LAT_RANGE = (-37.5, -36.0)
CENTROID_LON_RANGE = (174.0, 175.5)
STOP_TYPES = {0: "stop", 1: "station", 2: "entrance"}
STOP_TYPE_OTHER = "other"
CLOSED_STATUS = "Closed"
# --- end of fixed values ---


def stg_prices(raw: DataFrame) -> DataFrame:
    rd = landing_date(F.col("report_date"))
    return raw.select(
        "suburb",
        "district",
        rd.alias("report_date"),
        month_key(rd).alias("report_month"),
        "avg_sale_price",
        "avg_weekly_rent",
        "gross_yield_pct",
        quality_flag(F.col("avg_sale_price")).alias("data_quality_flag"),
    )


def stg_rates(raw: DataFrame) -> DataFrame:
    d = landing_date(F.col("date"))
    return raw.filter(F.col("ocr_rate").isNotNull()).select(
        d.alias("rate_date"),
        month_key(d).alias("rate_month"),
        F.col("ocr_rate").cast("double").alias("ocr_rate"),
        F.col("swap_rate_2yr").cast("double").alias("swap_rate_2yr"),
        F.col("bank_bill_90d").cast("double").alias("bank_bill_90d"),
        F.col("govt_bond_2yr").cast("double").alias("govt_bond_2yr"),
    )


def stg_census_income(landed_census: DataFrame) -> DataFrame:
    """Median household income per parent suburb (area names normalised)."""
    sel = (
        (F.col("section_title") == INCOME_METRIC)
        & (F.col("value_type_description") == INCOME_STATISTIC)
        & F.col("value").isNotNull()
    )
    return (
        landed_census.filter(sel)
        .groupBy(parent_suburb(F.col("descriptor")).alias("suburb"))
        .agg(F.round(F.avg(F.col("value").cast("double")), 0).alias("median_household_income"))
    )


def stg_schools(raw: DataFrame) -> DataFrame:
    # `status != 'Closed'` drops NULL status too (three-valued logic), and the
    # latitude test is on the raw text, so an unparseable latitude keeps its row.
    return raw.filter((F.col("status") != CLOSED_STATUS) & F.col("latitude").isNotNull()).select(
        "school_id",
        F.col("org_name").alias("school_name"),
        F.col("org_type").alias("school_type"),
        "authority",
        F.col("statistical_area_2_code").alias("sa2_code"),
        F.col("statistical_area_2_description").alias("sa2_name"),
        plain_suburb(F.col("add1_suburb")).alias("suburb"),
        F.col("add1_city").alias("city"),
        "territorial_authority",
        coerce_double("latitude").alias("lat"),
        coerce_double("longitude").alias("lon"),
        coerce_double("eqi_index").alias("eqi_index"),
        try_int(F.col("total")).alias("roll"),
        "status",
    )


def stg_supermarkets(landed: DataFrame) -> DataFrame:
    return landed.filter(F.col("suburb").isNotNull()).select(
        F.col("objectid").alias("supermarket_id"),
        F.lower(F.trim(F.col("name"))).alias("supermarket_name"),
        canonical_supermarket_suburb(F.col("suburb")).alias("suburb"),
    )


def stop_type(location_type) -> F.Column:
    expr = None
    for k, v in STOP_TYPES.items():
        expr = F.when(location_type == k, v) if expr is None else expr.when(location_type == k, v)
    return expr.otherwise(STOP_TYPE_OTHER)


def stg_stops(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("stop_lat").isNotNull() & F.col("stop_lon").isNotNull()).select(
        "stop_id",
        "stop_code",
        "stop_name",
        F.col("stop_lat").cast("double").alias("lat"),
        F.col("stop_lon").cast("double").alias("lon"),
        F.col("location_type").cast("int").alias("location_type"),
        stop_type(F.col("location_type")).alias("stop_type"),
        "parent_station",
    )


def suburb_centroids(schools: DataFrame) -> DataFrame:
    """Suburb centroid = mean school position inside the bounding box."""
    (lat_lo, lat_hi), (lon_lo, lon_hi) = CENTROID_LAT_RANGE, CENTROID_LON_RANGE
    return (
        schools.filter(F.col("lat").between(lat_lo, lat_hi) & F.col("lon").between(lon_lo, lon_hi))
        .groupBy("suburb")
        .agg(
            F.avg("lat").alias("centroid_lat"),
            F.avg("lon").alias("centroid_lon"),
            F.count(F.lit(1)).alias("school_count_for_centroid"),
        )
        .filter(F.col("school_count_for_centroid") >= 1)
    )


class Landing:
    """The six landing frames a pipeline run starts from.

    Each frame is built on first access from a zero-argument factory, so a
    query that needs one source never plans (or runs checks for) the others.
    """

    NAMES = ("prices", "rates", "census", "schools", "supermarkets", "stops")

    def __init__(self, **frames):
        unknown = set(frames) - set(self.NAMES)
        if unknown:
            raise TypeError(f"unknown landing frames: {sorted(unknown)}")
        self._factories = {}
        self._frames = {}
        for name, value in frames.items():
            if callable(value) and not isinstance(value, DataFrame):
                self._factories[name] = value
            else:
                self._frames[name] = value

    def __getattr__(self, name: str) -> DataFrame:
        if name not in Landing.NAMES:
            raise AttributeError(name)
        frames = self.__dict__["_frames"]
        if name not in frames:
            frames[name] = self.__dict__["_factories"][name]()
        return frames[name]

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str) -> "Landing":
        from tussock.sources import testdata as td
        from tussock.sources.ingest import ingest_census, ingest_supermarkets
        from tussock.sources.landing import LANDING_SCHEMAS, conform, read_table

        def census():
            nation = read_table(spark, sf_dir, "nation")
            places = nation.select(F.replace(F.col("n_name"), F.lit("NATION_"), F.lit("Mount ")).alias("keyword"))
            return ingest_census(td.a_census(spark, sf_dir), places=places)

        def stops():
            return td.a_stops(spark, sf_dir).select(
                "stop_id",
                F.lit(None).cast("string").alias("stop_code"),
                F.lit(None).cast("string").alias("stop_name"),
                "stop_lat",
                "stop_lon",
                "location_type",
                F.lit(None).cast("string").alias("parent_station"),
            )

        return cls(
            prices=lambda: td.a_prices(spark, sf_dir),
            rates=lambda: td.a_rates(spark, sf_dir),
            census=census,
            schools=lambda: conform(td.a_schools(spark, sf_dir), LANDING_SCHEMAS["schools"]),
            supermarkets=lambda: ingest_supermarkets(td.a_supermarkets(spark, sf_dir)),
            stops=stops,
        )

    @classmethod
    def from_registry(cls, registry) -> "Landing":
        return cls(**{
            "prices": lambda: registry.source("suburb_prices"),
            "rates": lambda: registry.source("interest_rates"),
            "census": lambda: registry.source("census"),
            "schools": lambda: registry.source("schools"),
            "supermarkets": lambda: registry.source("supermarkets"),
            "stops": lambda: registry.source("transit_stops"),
        })
