"""Ingest jobs: raw source frames -> landing frames.

Each job is a lazy DataFrame transform; landing is a separate sink call.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tussock.functions.cleaning import coerce_double, rename_columns, try_landing_date, with_audit
from tussock.operators.textmatch import contains_any, mark_contains, semi_join_contains

# --- Fixed values (source filters; must equal the source pipeline) ---
CENSUS_LEVEL = "Statistical area 2"
CENSUS_PERIOD = 2023
CENSUS_VALUE_TYPES = ["Median", "Count"]
CENSUS_TARGET_METRICS = [
    "Median household income",
    "Median personal income of adults",
    "Population",
    "Households who own their home or hold in a family trust",
    "Median weekly rent paid by households",
    "Number of private dwellings",
    "Median age",
    "New Zealand index of socioeconomic deprivation",
    "Work and labour force status",
]
AUCKLAND_PLACE_NAMES = [
    "Albany", "Avondale", "Birkdale", "Blockhouse Bay", "Botany",
    "Browns Bay", "Devonport", "East Tamaki", "Eden Terrace", "Ellerslie",
    "Epsom", "Flat Bush", "Glenfield", "Glen Innes", "Glen Eden",
    "Grey Lynn", "Helensville", "Henderson", "Hillsborough", "Howick",
    "Kelston", "Kohimarama", "Lynfield", "Mangere", "Manukau",
    "Manurewa", "Massey", "Meadowbank", "Mission Bay", "Mount Albert",
    "Mount Eden", "Mount Roskill", "Mount Wellington", "Newmarket",
    "New Lynn", "Northcote", "Onehunga", "One Tree Hill", "Orewa",
    "Otahuhu", "Otara", "Pakuranga", "Papakura", "Papatoetoe",
    "Parnell", "Penrose", "Point Chevalier", "Ponsonby", "Pukekohe",
    "Remuera", "Royal Oak", "Sandringham", "Silverdale", "St Heliers",
    "St Johns", "Sunnyvale", "Swanson", "Takanini", "Takapuna",
    "Three Kings", "Titirangi", "Waitakere", "Waiuku", "Westgate",
    "Whangaparaoa", "Wiri", "Beachlands", "Clevedon", "Drury",
    "Glenbrook", "Karaka", "Kumeu", "Wellsford", "Beach Haven", "Belmont", "Birkenhead", "Bucklands Beach",
    "City Centre", "Clendon Park", "Conifer Grove", "Dannemora",
    "Forrest Hill", "Glendene", "Glendowie", "Goodwood Heights",
    "Green Bay", "Greenlane", "Hobsonville", "Laingholm",
    "Mairangi Bay", "Mangere Bridge", "Manly", "Maraetai",
    "Milford", "New Windsor", "Northpark", "Red Beach",
    "Rothesay Bay", "Royal Heights", "Snells Beach", "Stanmore Bay",
    "Stonefields", "Sunnynook", "Te Atatu Peninsula", "Te Atatu South",
    "Torbay", "Tuakau", "Warkworth", "Waterview", "Wattle Downs",
    "West Harbour", "Westmere", "Weymouth",
]
# Place names without an income match, probed against the census area names.
MISSING_PLACE_NAMES = [
    "Flat Bush", "Mangere", "Mangere Bridge",
    "Otahuhu", "Otara", "Ranui",
    "St Heliers", "Te Atatu Peninsula", "Te Atatu South",
]
SUPERMARKET_AUTHORITY = "Auckland"
SUPERMARKET_RENAMES = {"Town - City": "Town_City", "Shape__Area": "Shape_Area", "Shape__Length": "Shape_Length"}
# Rate-file positions: date, OCR, 90-day bill, 2-year bond, 2-year swap.
RATE_FILE_POSITIONS = [0, 1, 7, 9, 17]
RATE_COLUMNS = ["date", "ocr_rate", "bank_bill_90d", "govt_bond_2yr", "swap_rate_2yr"]
# Manual patch for months the published rate file lags behind.
RATE_PATCH_ROWS = [
    ("2025-08-31", 2.75, 2.90, 3.30, 3.20),
    ("2025-09-30", 2.75, 2.85, 3.25, 3.10),
    ("2025-10-31", 2.75, 2.80, 3.20, 3.00),
    ("2025-11-30", 2.25, 2.50, 3.50, 3.45),
    ("2025-12-31", 2.25, 2.55, 3.70, 3.75),
    ("2026-01-31", 2.25, 2.60, 3.65, 3.70),
    ("2026-02-28", 2.25, 2.60, 3.60, 3.65),
    ("2026-03-31", 2.25, 2.60, 3.60, 3.65),
]
# --- end of fixed values ---

RATE_SCHEMA = T.StructType(
    [T.StructField("date", T.DateType(), True)]
    + [T.StructField(c, T.DoubleType(), True) for c in RATE_COLUMNS[1:]]
)


# ---------------------------------------------------------------- census ---

def census_stage_predicates(place_match):
    """Cumulative ingest predicates, in order, as (step name, Column)."""
    return [
        ("sa2_2023", (F.col("classification_label") == CENSUS_LEVEL) & (F.col("period") == CENSUS_PERIOD)),
        ("target_metric", F.col("section_title").isin(CENSUS_TARGET_METRICS)),
        ("place_name", place_match),
        ("value_type", F.col("value_type_description").isin(CENSUS_VALUE_TYPES)),
        ("numeric_value", coerce_double("value").isNotNull()),
    ]


def ingest_census(raw: DataFrame, places: list[str] | DataFrame = AUCKLAND_PLACE_NAMES,
                  audit: bool = False) -> DataFrame:
    """SA2 + 2023 -> target metrics -> place-name substring match -> Median/Count
    -> coercing numeric parse with NULL/NaN dropped.

    ``places`` is either a list of literal names (one case-insensitive alternation)
    or a DataFrame with one ``keyword`` column (a table-driven semi join).
    """
    df = raw.filter((F.col("classification_label") == CENSUS_LEVEL) & (F.col("period") == CENSUS_PERIOD))
    df = df.filter(F.col("section_title").isin(CENSUS_TARGET_METRICS))
    if isinstance(places, DataFrame):
        df = semi_join_contains(df, "descriptor", places, "keyword")
    else:
        df = df.filter(contains_any(F.col("descriptor"), places, escape=True))
    df = df.filter(F.col("value_type_description").isin(CENSUS_VALUE_TYPES))
    df = df.withColumn("value", coerce_double("value")).filter(F.col("value").isNotNull())
    return with_audit(df) if audit else df


def census_funnel(raw: DataFrame, places: list[str] | DataFrame = AUCKLAND_PLACE_NAMES) -> DataFrame:
    """Row counts after each ingest step, computed in ONE pass with count_if over
    cumulative predicates (instead of one count job per step)."""
    if isinstance(places, DataFrame):
        raw = mark_contains(raw, "descriptor", places, "keyword", "_place_ok")
        place_match = F.col("_place_ok")
    else:
        place_match = contains_any(F.col("descriptor"), places, escape=True)
    preds = census_stage_predicates(place_match)
    aggs = [F.count(F.lit(1)).alias("loaded")]
    acc = None
    for name, p in preds:
        acc = p if acc is None else (acc & p)
        aggs.append(F.count_if(F.coalesce(acc, F.lit(False))).alias(name))
    wide = raw.agg(*aggs)
    names = ["loaded"] + [n for n, _ in preds]
    stack = ", ".join(f"{i}, '{n}', `{n}`" for i, n in enumerate(names))
    return wide.selectExpr(f"stack({len(names)}, {stack}) as (step_no, step, row_count)")


# ----------------------------------------------------------------- rates ---

def rates_from_positions(raw: DataFrame, date_format: str | None = None) -> DataFrame:
    """Headerless rate file: pick columns by position, coerce the date (preamble
    and footnote rows become NULL and are dropped), coerce the numbers.
    ``date_format`` (e.g. ``'dd/MM/yyyy'``) when the export does not use ISO dates."""
    cols = raw.columns
    picked = raw.select(*[F.col(f"`{cols[i]}`").alias(n) for i, n in zip(RATE_FILE_POSITIONS, RATE_COLUMNS)])
    return picked.select(
        try_landing_date("date", date_format).alias("date"),
        *[coerce_double(c).alias(c) for c in RATE_COLUMNS[1:]],
    ).filter(F.col("date").isNotNull())


def rate_patch(spark: SparkSession, rows=RATE_PATCH_ROWS) -> DataFrame:
    typed = [(_dt.date.fromisoformat(d), *vals) for d, *vals in rows]
    return spark.createDataFrame(typed, RATE_SCHEMA)


def patch_union(base: DataFrame, patch: DataFrame, date_col: str = "date") -> DataFrame:
    """Drop every base row on/after the patch's first date, then append the patch.

    The cutover is a scalar subquery (one value computed once), so the base
    side is filtered in place without a shuffle. The patch replaces the whole
    tail, not only matching keys.
    """
    cutover = patch.agg(F.min(date_col)).scalar()
    kept = base.filter(F.col(date_col) < cutover)
    return kept.unionByName(patch.select(*base.columns))


# ---------------------------------------------------------- supermarkets ---

def ingest_supermarkets(raw: DataFrame, authority: str = SUPERMARKET_AUTHORITY, audit: bool = False) -> DataFrame:
    df = raw.filter(F.col("territorial_authority") == authority)
    df = rename_columns(df, SUPERMARKET_RENAMES)
    return with_audit(df) if audit else df


def value_frequency(df: DataFrame, col: str, top: int | None = None) -> DataFrame:
    """Value counts, most frequent first (NULL group removed); ties by value."""
    out = (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("row_count"))
           .orderBy(F.desc("row_count"), F.asc(col)))
    return out.limit(top) if top else out


def ingest_supermarket_file(raw: DataFrame, authority: str = SUPERMARKET_AUTHORITY, audit: bool = False) -> DataFrame:
    """Supermarket file with its original headers: keep one authority, rename
    the awkward headers, fold names to upper case for landing."""
    df = raw.filter(F.col("`Territorial Authority`") == authority)
    df = rename_columns(df, SUPERMARKET_RENAMES)
    df = with_audit(df) if audit else df
    return df.toDF(*[c.upper() for c in df.columns])


# ------------------------------------------------------------ price pages ---

def ingest_price_pages(pages: DataFrame, calendar: DataFrame, path_of_url, audit: bool = False) -> DataFrame:
    """Captured monthly report pages -> price landing rows, all months in one job.

    ``pages`` has (url, status, html); ``calendar`` is a calendar grid (one row
    per month with ``path``, ``year``, ``month``, ``report_date``);
    ``path_of_url`` is a Column expression extracting that path from ``url``.
    Non-200 responses are dropped (triage), each page is matched to its month
    by path (the calendar is broadcast: 12 rows per year), and the
    report tables of every page are extracted in one distributed pass, which
    replaces a per-month request loop and a concatenation of the results.
    """
    from tussock.sources.html import report_rows

    ok = pages.filter(F.col("status") == 200).withColumn("path", path_of_url)
    # The calendar has 12 rows per year, whatever the pages, so it is broadcast
    # and the pages, which carry the HTML, are never shuffled for this join.
    months = F.broadcast(calendar.select("path", "year", "month", "report_date"))
    dated = ok.join(months, "path", "inner")
    rows = report_rows(dated, "url", carry=["year", "month", "report_date"])
    out = rows.select("year", "month", "report_date", "district", "suburb",
                      "avg_sale_price", "avg_weekly_rent", "gross_yield_pct")
    return with_audit(out) if audit else out


def census_name_probe(raw: DataFrame, names: list[str] | DataFrame = MISSING_PLACE_NAMES) -> DataFrame:
    """For each place name, the distinct SA2 2023 median-income area names that
    contain it (case-insensitive), or 'NOT FOUND' (keyword probe over the census)."""
    from tussock.operators.quality import keyword_probe

    areas = raw.filter(
        (F.col("classification_label") == CENSUS_LEVEL) & (F.col("period") == CENSUS_PERIOD)
        & (F.col("section_title") == "Median household income") & (F.col("value_type_description") == "Median"))
    if not isinstance(names, DataFrame):
        names = raw.sparkSession.createDataFrame([(n,) for n in names], "keyword string")
    return keyword_probe(areas, "descriptor", names, names.columns[0])
