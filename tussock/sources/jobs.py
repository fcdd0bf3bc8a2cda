"""Ingest jobs from raw files to landing tables (full replace, audit column).

One function per source; each reads the raw file with an explicit schema or
envelope, applies the source's cleaning job, conforms the result to the
landing schema and writes it. Returns the row count written.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tussock.functions.cleaning import datetime_text
from tussock.sources import ingest as ing
from tussock.sources.calendar import calendar_grid
from tussock.sources.landing import (
    LANDING_SCHEMAS, conform, read_census_file, read_headerless, read_json_members,
)
from tussock.sources.sinks import write_landing

# --- Fixed values (columns kept from the school records, in source spelling) ---
SCHOOL_KEEP_COLUMNS = [
    "School_Id", "Org_Name", "Org_Type", "Authority", "CoEd_Status",
    "Add1_Suburb", "Add1_City", "Territorial_Authority", "Regional_Council",
    "Statistical_Area_2_Code", "Statistical_Area_2_Description",
    "Latitude", "Longitude", "EQi_Index", "Total", "Status", "DateSchoolOpened",
]
CENSUS_KEEP_COLUMNS = ["section_title", "classification_label", "descriptor", "period",
                       "value_type_description", "value", "value_label"]
# Month path inside a report page URL, e.g. .../2025/march/suburb-report
REPORT_PATH_PATTERN = r"(\d{4}/[a-z]+)/suburb-report"
# --- end of fixed values ---


def _own_columns(table: str) -> list[str]:
    """Columns of a landing table that its source must bring: all but the audit column."""
    return [c for c in LANDING_SCHEMAS[table].names if c != "ingested_at"]


def _land(df: DataFrame, table: str, landing_root: str) -> int:
    """Write ``df`` as the landing table; a column the source lacks raises ``KeyError`` before anything is replaced."""
    frame = conform(df, LANDING_SCHEMAS[table], required=_own_columns(table)).drop("ingested_at")
    return write_landing(frame, os.path.join(landing_root, table))


def _snake(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


def ingest_rates_file(spark: SparkSession, path: str, landing_root: str, date_format: str | None = None) -> int:
    """Rate spreadsheet export (CSV, no header, preamble rows) -> interest_rates,
    with the manual patch applied; dates land as text like every datetime."""
    base = ing.rates_from_positions(read_headerless(spark, path, max(ing.RATE_FILE_POSITIONS) + 1), date_format)
    rates = ing.patch_union(base, ing.rate_patch(spark))
    return _land(rates.withColumn("date", datetime_text("date")), "interest_rates", landing_root)


def ingest_census_file(spark: SparkSession, path: str, landing_root: str,
                       places: list[str] | DataFrame = ing.AUCKLAND_PLACE_NAMES) -> int:
    raw = read_census_file(spark, path, keep=CENSUS_KEEP_COLUMNS)
    raw = raw.withColumn("period", F.col("period").try_cast("int"))
    return _land(ing.ingest_census(raw, places), "census", landing_root)


def ingest_supermarkets_file(spark: SparkSession, path: str, landing_root: str) -> int:
    raw = spark.read.option("header", True).csv(path)          # every column as text
    return _land(_snake(ing.ingest_supermarket_file(raw)), "supermarkets", landing_root)


def ingest_stops_file(spark: SparkSession, path: str, landing_root: str, json_lines: bool = False) -> int:
    """Stop payload -> transit_stops; ``json_lines`` for a bulk export, one envelope a line, which many tasks can read."""
    stops = read_json_members(spark, path, "data", _own_columns("transit_stops"), inner="attributes", multiline=not json_lines)
    return _land(_snake(stops), "transit_stops", landing_root)


def ingest_schools_file(spark: SparkSession, path: str, landing_root: str, json_lines: bool = False) -> int:
    """School payload -> schools; ``json_lines`` as for the stops."""
    records = read_json_members(spark, path, "result.records", SCHOOL_KEEP_COLUMNS, multiline=not json_lines)
    return _land(_snake(records), "schools", landing_root)


def ingest_price_pages_file(spark: SparkSession, path: str, landing_root: str, start_year: int, end_year: int,
                            path_pattern: str = REPORT_PATH_PATTERN) -> int:
    """Captured report pages (parquet with url, status, html) -> suburb_prices."""
    pages = spark.read.parquet(path)
    bounds = spark.createDataFrame([(start_year, end_year)], "start_year int, end_year int")
    rows = ing.ingest_price_pages(pages, calendar_grid(bounds), F.regexp_extract("url", path_pattern, 1))
    return _land(rows, "suburb_prices", landing_root)
