"""Query catalogue: name -> (spark, sf_dir) -> DataFrame, with SQL oracles.

Every query reads the test tables (through the landing adapters) in full.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tussock.plans import marts
from tussock.plans import oracle as O
from tussock.plans import staging as stg
from tussock.sources import testdata as td

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def landing(spark: SparkSession, sf_dir: str) -> stg.Landing:
    return stg.Landing.from_testdata(spark, sf_dir)


# ------------------------------------------------------------- staging ---

@register("stg_prices_flagged", O.build("SELECT * FROM stg_prices", ["stg_prices"]))
def q_stg_prices(spark, sf_dir):
    return stg.stg_prices(td.a_prices(spark, sf_dir))


@register("stg_rates_monthly", O.build("SELECT * FROM stg_rates", ["stg_rates"]))
def q_stg_rates(spark, sf_dir):
    return stg.stg_rates(td.a_rates(spark, sf_dir))


@register("stg_census_income", O.build("SELECT * FROM stg_census_income", ["stg_census_income"]))
def q_stg_census(spark, sf_dir):
    return stg.stg_census_income(landing(spark, sf_dir).census)


@register("stg_schools_clean", O.build("SELECT * FROM stg_schools", ["stg_schools"]))
def q_stg_schools(spark, sf_dir):
    return stg.stg_schools(landing(spark, sf_dir).schools)


@register("stg_supermarkets_alias", O.build("SELECT * FROM stg_supermarkets", ["stg_supermarkets"]))
def q_stg_supermarkets(spark, sf_dir):
    return stg.stg_supermarkets(landing(spark, sf_dir).supermarkets)


@register("stg_stops_typed", O.build("SELECT * FROM stg_stops", ["stg_stops"]))
def q_stg_stops(spark, sf_dir):
    return stg.stg_stops(landing(spark, sf_dir).stops)


@register("suburb_centroids", O.build("SELECT * FROM suburb_centroids", ["suburb_centroids"]))
def q_centroids(spark, sf_dir):
    return stg.suburb_centroids(stg.stg_schools(landing(spark, sf_dir).schools))


# --------------------------------------------------------------- marts ---

@register("property_by_suburb_month", O.build("SELECT * FROM property", ["property"]))
def q_property(spark, sf_dir):
    return marts.property_by_suburb_month(stg.stg_prices(td.a_prices(spark, sf_dir)))


@register("affordability_mart", O.build("SELECT * FROM mart_aff", ["mart_aff"]))
def q_affordability(spark, sf_dir):
    return marts.affordability_mart(landing(spark, sf_dir))


@register("school_scores", O.build("SELECT * FROM int_school_scores", ["int_school_scores"]))
def q_school_scores(spark, sf_dir):
    return marts.school_scores(stg.stg_schools(landing(spark, sf_dir).schools))


@register("amenity_scores", O.build("SELECT * FROM int_supermarket_scores", ["int_supermarket_scores"]))
def q_amenity_scores(spark, sf_dir):
    return marts.amenity_scores(stg.stg_supermarkets(landing(spark, sf_dir).supermarkets))


@register("transit_scores", O.build("SELECT * FROM int_transit_scores", ["int_transit_scores"]))
def q_transit_scores(spark, sf_dir):
    l = landing(spark, sf_dir)
    centroids = stg.suburb_centroids(stg.stg_schools(l.schools))
    return marts.transit_scores(centroids, stg.stg_stops(l.stops))


@register("liveability_mart", O.build("SELECT * FROM mart_live", ["mart_live"]))
def q_liveability(spark, sf_dir):
    return marts.liveability_mart(landing(spark, sf_dir))


# ------------------------------------------------------------- metrics ---

@register("gross_yield_check", O.build(f"""
SELECT suburb, district, report_date, avg_sale_price, avg_weekly_rent, gross_yield_pct,
       avg_weekly_rent * 52 / NULLIF(avg_sale_price, 0) * 100 AS computed_yield_pct,
       {O.rnd('abs(gross_yield_pct - avg_weekly_rent * 52 / NULLIF(avg_sale_price, 0) * 100)', 6, 14)} AS yield_gap
FROM stg_prices""", ["stg_prices"]))
def q_gross_yield(spark, sf_dir):
    from tussock.functions.metrics import gross_yield_pct
    p = stg.stg_prices(td.a_prices(spark, sf_dir))
    computed = gross_yield_pct(F.col("avg_weekly_rent"), F.col("avg_sale_price"))
    return p.select(
        "suburb", "district", "report_date", "avg_sale_price", "avg_weekly_rent", "gross_yield_pct",
        computed.alias("computed_yield_pct"),
        F.round(F.abs(F.col("gross_yield_pct") - computed), 6).alias("yield_gap"),
    )


# --------------------------------------------------------- source jobs ---

def _rates_positional(spark, sf_dir):
    from tussock.sources.ingest import rates_from_positions
    return rates_from_positions(td.a_rate_sheet(spark, sf_dir))


def _rates_patched(spark, sf_dir):
    from tussock.sources.ingest import patch_union, rate_patch
    return patch_union(_rates_positional(spark, sf_dir), rate_patch(spark))


@register("positional_projection", O.build("SELECT * FROM rates_positional", ["rates_positional"]))
def q_positional(spark, sf_dir):
    return _rates_positional(spark, sf_dir)


@register("rates_patch_union", O.build("SELECT * FROM rates_patched", ["rates_patched"]))
def q_patch_union(spark, sf_dir):
    return _rates_patched(spark, sf_dir).orderBy("date")


@register("first_last_sample", O.build("""
SELECT * FROM (SELECT 'head' AS position, * FROM rates_patched ORDER BY date LIMIT 5)
UNION ALL
SELECT * FROM (SELECT 'tail' AS position, * FROM rates_patched ORDER BY date DESC LIMIT 5)""", ["rates_patched"]))
def q_first_last(spark, sf_dir):
    r = _rates_patched(spark, sf_dir)
    head = r.orderBy(F.asc("date")).limit(5).select(F.lit("head").alias("position"), *r.columns)
    tail = r.orderBy(F.desc("date")).limit(5).select(F.lit("tail").alias("position"), *r.columns)
    return head.unionByName(tail)


@register("monthly_union", O.build("""
SELECT report_month, count(*) AS n_rows, count(DISTINCT suburb) AS n_suburbs
FROM stg_prices GROUP BY report_month""", ["stg_prices"]))
def q_monthly_union(spark, sf_dir):
    """Two landing batches (split by price band) recombined with a bag union
    by column name; duplicates are kept, column order may differ."""
    p = stg.stg_prices(td.a_prices(spark, sf_dir))
    low = p.filter(F.col("avg_sale_price").isNull() | (F.col("avg_sale_price") <= 2000000))
    high = p.filter(F.col("avg_sale_price") > 2000000).select(*reversed(p.columns))
    both = low.unionByName(high)
    return both.groupBy("report_month").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("suburb").alias("n_suburbs"))


@register("census_ingest_filter", O.build("SELECT * FROM l_census", ["l_census"]))
def q_census_filter(spark, sf_dir):
    return landing(spark, sf_dir).census


@register("census_ingest_funnel", O.build("""
SELECT 0 AS step_no, 'loaded' AS step, count(*) AS row_count FROM census_marked
UNION ALL SELECT 1, 'sa2_2023', count(*) FILTER (WHERE s1) FROM census_marked
UNION ALL SELECT 2, 'target_metric', count(*) FILTER (WHERE s1 AND s2) FROM census_marked
UNION ALL SELECT 3, 'place_name', count(*) FILTER (WHERE s1 AND s2 AND s3) FROM census_marked
UNION ALL SELECT 4, 'value_type', count(*) FILTER (WHERE s1 AND s2 AND s3 AND s4) FROM census_marked
UNION ALL SELECT 5, 'numeric_value', count(*) FILTER (WHERE s1 AND s2 AND s3 AND s4 AND s5) FROM census_marked""",
    ["census_marked"]))
def q_census_funnel(spark, sf_dir):
    from tussock.sources.ingest import census_funnel
    from tussock.sources.landing import read_table
    nation = read_table(spark, sf_dir, "nation")
    places = nation.select(F.replace(F.col("n_name"), F.lit("NATION_"), F.lit("Mount ")).alias("keyword"))
    return census_funnel(td.a_census(spark, sf_dir), places)


@register("calendar_grid", O.build("""
SELECT CAST(year(d) AS INTEGER) AS year,
       lower(monthname(d)) AS month,
       CAST(month(d) AS INTEGER) AS month_no,
       make_date(year(d), list_position(['january','february','march','april','may','june','july','august',
                 'september','october','november','december'], lower(monthname(d))), 1) AS month_start,
       strftime(d, '%Y-%m-%d') || ' 00:00:00' AS report_date,
       CAST(year(d) AS VARCHAR) || '/' || lower(monthname(d)) AS path
FROM (SELECT CAST(unnest(generate_series(make_date(year(min(o_orderdate)), 1, 1),
                                         make_date(year(max(o_orderdate)), 12, 1), INTERVAL 1 MONTH)) AS DATE) AS d
      FROM orders) g""", []))
def q_calendar(spark, sf_dir):
    from tussock.sources.calendar import calendar_grid, month_start
    from tussock.sources.landing import read_table
    o = read_table(spark, sf_dir, "orders")
    bounds = o.agg(F.year(F.min("o_orderdate")).alias("start_year"), F.year(F.max("o_orderdate")).alias("end_year"))
    g = calendar_grid(bounds)
    return g.select("year", "month", "month_no", month_start(F.col("year"), F.col("month")).alias("month_start"),
                    "report_date", "path")


@register("currency_parse", O.build("""
SELECT id, price_text, yield_text,
       TRY_CAST(trim(replace(replace(price_text, '$', ''), ',', '')) AS DOUBLE) AS price,
       TRY_CAST(trim(replace(yield_text, '%', '')) AS DOUBLE) AS yield_pct
FROM a_money""", ["a_money"]))
def q_currency(spark, sf_dir):
    from tussock.functions.cleaning import parse_money, parse_percent
    m = td.a_money(spark, sf_dir)
    return m.select("id", "price_text", "yield_text", parse_money("price_text").alias("price"),
                    parse_percent("yield_text").alias("yield_pct"))


@register("column_fold_rename", O.build("""
SELECT "OBJECTID", "Name" AS "NAME", "Suburb" AS "SUBURB", "Town - City" AS "TOWN_CITY",
       "Territorial Authority" AS "TERRITORIAL AUTHORITY", "Shape__Area" AS "SHAPE_AREA",
       "Shape__Length" AS "SHAPE_LENGTH"
FROM a_supermarket_file WHERE "Territorial Authority" = 'Auckland'""", ["a_supermarket_file"]))
def q_fold_rename(spark, sf_dir):
    from tussock.sources.ingest import ingest_supermarket_file
    return ingest_supermarket_file(td.a_supermarket_file(spark, sf_dir))


@register("value_frequency_top10", O.build("""
SELECT "Town - City" AS "TOWN_CITY", count(*) AS row_count
FROM a_supermarket_file WHERE "Territorial Authority" = 'Auckland' AND "Town - City" IS NOT NULL
GROUP BY 1 ORDER BY row_count DESC, 1 LIMIT 10""", ["a_supermarket_file"]))
def q_value_freq(spark, sf_dir):
    from tussock.sources.ingest import ingest_supermarket_file, value_frequency
    return value_frequency(ingest_supermarket_file(td.a_supermarket_file(spark, sf_dir)), "TOWN_CITY", top=10)


@register("json_envelope_flatten", O.build("""
SELECT event_id, r.id AS id, r.attributes.k AS k
FROM (SELECT event_id,
             unnest(from_json(payload, '{"data":[{"id":"BIGINT","attributes":{"k":"BIGINT"}}]}').data) AS r
      FROM a_envelope)""", ["a_envelope"]))
def q_json(spark, sf_dir):
    from pyspark.sql import types as T

    from tussock.sources.payloads import envelope_schema, flatten_envelope
    record = T.StructType([
        T.StructField("id", T.LongType()),
        T.StructField("attributes", T.StructType([T.StructField("k", T.LongType())])),
    ])
    env = td.a_envelope(spark, sf_dir)
    flat = flatten_envelope(env, "payload", envelope_schema(record), "data", keep=["event_id"])
    return flat.select("event_id", "id", F.col("attributes.k").alias("k"))


@register("html_blocks_with_heading", O.build("""
SELECT page_id, url, heading, pos AS block_pos, text FROM page_blocks
WHERE kind = 'block' AND heading IS NOT NULL AND heading <> ''""", ["page_blocks"]))
def q_html_blocks(spark, sf_dir):
    from tussock.sources.html import heading_blocks
    pages = td.a_pages(spark, sf_dir).filter(F.col("status") == 200)
    return heading_blocks(pages, "page_id", heading_tag="h1", block_tag="p", carry=["url"])


@register("html_response_triage", O.build("""
SELECT page_id, url, status,
       CASE WHEN status != 200 THEN 'http_' || CAST(status AS VARCHAR)
            WHEN NOT coalesce(regexp_matches(html, '(?i)<p[\\s>]'), false) THEN 'no_content'
            ELSE 'ok' END AS reason
FROM a_pages""", ["a_pages"]))
def q_triage(spark, sf_dir):
    from tussock.sources.html import triage
    return triage(td.a_pages(spark, sf_dir), content_tag="p").select("page_id", "url", "status", "reason")


# -------------------------------------------------------------- reports ---

def _mart(spark, sf_dir):
    """The mart as a plan; reports over a stored mart are in ``plans.pipeline``."""
    return marts.affordability_mart(landing(spark, sf_dir))


def _dates(spark, sf_dir):
    """The mart's report dates without its joins."""
    return marts.report_dates(stg.stg_prices(td.a_prices(spark, sf_dir)))


REPORT_SELECTION = ["Ponsonby", "Remuera", "Avondale", "Manurewa", "Mt 1", "Mt 4", "Mt 12"]


@register("report_index_over_time", O.build(f"""
SELECT report_date, suburb, {O.dmean('affordability_index')} AS affordability_index
FROM mart_aff
WHERE suburb IN {O._in_list(REPORT_SELECTION)} AND report_date IS NOT NULL
GROUP BY report_date, suburb""", ["mart_aff"]))
def q_index_over_time(spark, sf_dir):
    from tussock.plans.reports import index_over_time
    wanted = spark.createDataFrame([(s,) for s in REPORT_SELECTION], "suburb string")
    return index_over_time(_mart(spark, sf_dir), wanted)


@register("report_price_to_income_3m", O.build(f"""
SELECT suburb, {O.dmean('price_to_income_ratio')} AS price_to_income_ratio
FROM recent WHERE suburb IS NOT NULL GROUP BY suburb
HAVING avg(price_to_income_ratio) IS NOT NULL""", ["recent"]))
def q_pti_3m(spark, sf_dir):
    from tussock.plans.reports import price_to_income_recent
    return price_to_income_recent(_mart(spark, sf_dir), dates=_dates(spark, sf_dir))


@register("report_rate_cycle", O.build("SELECT * FROM rate_cycle", ["rate_cycle"]))
def q_rate_cycle(spark, sf_dir):
    from tussock.plans.reports import rate_cycle
    return rate_cycle(_mart(spark, sf_dir))


@register("report_top_schools", O.build("""
SELECT suburb, avg_eqi_index, school_count FROM (
  SELECT suburb, avg_eqi_index, school_count,
         row_number() OVER (PARTITION BY suburb ORDER BY avg_eqi_index DESC, school_count DESC) AS rn
  FROM mart_aff
  WHERE report_date = (SELECT max(report_date) FROM mart_aff) AND avg_eqi_index IS NOT NULL) t
WHERE rn = 1 ORDER BY avg_eqi_index DESC, suburb LIMIT 30""", ["mart_aff"]))
def q_top_schools(spark, sf_dir):
    from tussock.plans.reports import top_schools
    return top_schools(_mart(spark, sf_dir), dates=_dates(spark, sf_dir))


@register("report_top_amenity", O.build("""
SELECT suburb, supermarket_count FROM (
  SELECT suburb, supermarket_count,
         row_number() OVER (PARTITION BY suburb ORDER BY supermarket_count DESC) AS rn
  FROM mart_aff
  WHERE report_date = (SELECT max(report_date) FROM mart_aff) AND supermarket_count IS NOT NULL) t
WHERE rn = 1 ORDER BY supermarket_count DESC, suburb LIMIT 30""", ["mart_aff"]))
def q_top_amenity(spark, sf_dir):
    from tussock.plans.reports import top_amenity
    return top_amenity(_mart(spark, sf_dir), dates=_dates(spark, sf_dir))


@register("report_yield_3m", O.build(f"""
SELECT suburb, {O.dmean('gross_yield_pct')} AS gross_yield_pct, avg(avg_sale_price) AS avg_sale_price
FROM recent WHERE suburb IS NOT NULL GROUP BY suburb
HAVING avg(gross_yield_pct) IS NOT NULL""", ["recent"]))
def q_yield_3m(spark, sf_dir):
    from tussock.plans.reports import yield_recent
    return yield_recent(_mart(spark, sf_dir), dates=_dates(spark, sf_dir))


@register("report_peak_to_trough", O.build(f"""
SELECT p.peak_date, p.peak_value, t.trough_date, t.trough_value,
       {O.rnd('(t.trough_value - p.peak_value) / p.peak_value * 100', 2)} AS change_pct
FROM (SELECT report_date AS peak_date, avg_sale_price AS peak_value FROM rate_cycle
      WHERE avg_sale_price IS NOT NULL ORDER BY avg_sale_price DESC, report_date LIMIT 1) p
LEFT JOIN (SELECT report_date AS trough_date, avg_sale_price AS trough_value FROM rate_cycle
      WHERE avg_sale_price IS NOT NULL
        AND report_date > (SELECT report_date FROM rate_cycle WHERE avg_sale_price IS NOT NULL
                           ORDER BY avg_sale_price DESC, report_date LIMIT 1)
      ORDER BY avg_sale_price, report_date LIMIT 1) t ON true""", ["rate_cycle"]))
def q_peak_to_trough(spark, sf_dir):
    from tussock.plans.reports import peak_to_trough, rate_cycle
    return peak_to_trough(rate_cycle(_mart(spark, sf_dir)))


@register("distinct_profile", O.build("""
SELECT count(*) AS n_rows, count(DISTINCT suburb) AS n_distinct, min(report_date) AS first_date,
       max(report_date) AS last_date, strftime(max(report_date), '%b %Y') AS latest_label
FROM mart_aff""", ["mart_aff"]))
def q_distinct_profile(spark, sf_dir):
    from tussock.operators.quality import distinct_profile
    return distinct_profile(_mart(spark, sf_dir), "suburb", "report_date")


# -------------------------------------------------------------- quality ---

@register("dq_not_null", O.build(
    "SELECT column_name, failing_rows, failing_rows = 0 AS passed FROM mart_null_counts", ["mart_null_counts"]))
def q_dq_not_null(spark, sf_dir):
    from tussock.operators.quality import not_null_report
    return not_null_report(_mart(spark, sf_dir), ["report_date", "suburb", "avg_sale_price"])


@register("dq_duplicate_keys", O.build("""
SELECT suburb, report_date, count(*) AS row_count FROM stg_prices
GROUP BY suburb, report_date HAVING count(*) > 1""", ["stg_prices"]))
def q_dq_dupes(spark, sf_dir):
    from tussock.operators.quality import duplicate_keys
    return duplicate_keys(stg.stg_prices(td.a_prices(spark, sf_dir)), ["suburb", "report_date"])


@register("dq_mart_unique", O.build("""
SELECT suburb, report_date, count(*) AS row_count FROM mart_aff
GROUP BY suburb, report_date HAVING count(*) > 1""", ["mart_aff"]))
def q_dq_mart_unique(spark, sf_dir):
    from tussock.operators.quality import duplicate_keys
    return duplicate_keys(_mart(spark, sf_dir), ["suburb", "report_date"])


def _coverage_inputs(spark, sf_dir):
    from tussock.functions.names import suburb_key
    l = landing(spark, sf_dir)
    keys = (marts.property_by_suburb_month(stg.stg_prices(l.prices))
            .select(suburb_key(F.col("suburb")).alias("k")).distinct())
    sources = {
        "census": (stg.stg_census_income(l.census), "suburb"),
        "schools": (stg.stg_schools(l.schools), "suburb"),
        "supermarkets": (stg.stg_supermarkets(l.supermarkets), "suburb"),
    }
    return l, keys, sources


@register("coverage_unmatched", O.build("SELECT * FROM coverage_unmatched", ["coverage_unmatched"]))
def q_coverage_unmatched(spark, sf_dir):
    from tussock.operators.quality import unmatched_keys
    _, keys, sources = _coverage_inputs(spark, sf_dir)
    return unmatched_keys(keys, "k", sources)


@register("coverage_rate", O.build(f"""
SELECT source, n_keys, n_keys - n_unmatched AS n_matched, n_unmatched,
       {O.rnd('(n_keys - n_unmatched) / NULLIF(n_keys, 0)', 4)} AS match_rate
FROM (SELECT s.source, (SELECT count(*) FROM mart_keys) AS n_keys, coalesce(u.n_unmatched, 0) AS n_unmatched
      FROM (VALUES ('census'), ('schools'), ('supermarkets')) s(source)
      LEFT JOIN (SELECT source, count(*) AS n_unmatched FROM coverage_unmatched GROUP BY source) u
        ON u.source = s.source) t""", ["mart_keys", "coverage_unmatched"]))
def q_coverage_rate(spark, sf_dir):
    from tussock.operators.quality import match_rates
    _, keys, sources = _coverage_inputs(spark, sf_dir)
    return match_rates(keys, "k", sources)


@register("keyword_probe", O.build("""
SELECT k.suburb_key AS keyword, coalesce(m.descriptor, 'NOT FOUND') AS match
FROM (SELECT DISTINCT suburb_key FROM coverage_unmatched WHERE source = 'census') k
LEFT JOIN (SELECT DISTINCT descriptor FROM a_census
           WHERE classification_label = 'Statistical area 2' AND period = 2023
             AND section_title = 'Median household income' AND value_type_description = 'Median'
             AND descriptor IS NOT NULL) m
  ON contains(lower(m.descriptor), lower(k.suburb_key))""", ["coverage_unmatched", "a_census"]))
def q_keyword_probe(spark, sf_dir):
    from tussock.operators.quality import keyword_probe, unmatched_keys
    _, keys, sources = _coverage_inputs(spark, sf_dir)
    missing = unmatched_keys(keys, "k", sources).filter(F.col("source") == "census")
    census = td.a_census(spark, sf_dir).filter(
        (F.col("classification_label") == "Statistical area 2") & (F.col("period") == 2023)
        & (F.col("section_title") == "Median household income") & (F.col("value_type_description") == "Median"))
    return keyword_probe(census, "descriptor", missing, "suburb_key")


@register("table_profile", O.build("""
SELECT 'prices' AS table_name, count(*) AS row_count, 6 AS column_count FROM a_prices
UNION ALL SELECT 'rates', count(*), 5 FROM a_rates
UNION ALL SELECT 'census', count(*), 6 FROM l_census
UNION ALL SELECT 'schools', count(*), 18 FROM a_schools
UNION ALL SELECT 'supermarkets', count(*), 4 FROM l_supermarkets
UNION ALL SELECT 'stops', count(*), 7 FROM a_stops""",
    ["a_prices", "a_rates", "l_census", "a_schools", "l_supermarkets", "a_stops"]))
def q_table_profile(spark, sf_dir):
    from tussock.operators.quality import table_profile
    l = landing(spark, sf_dir)
    return table_profile({"prices": l.prices, "rates": l.rates, "census": l.census, "schools": l.schools,
                          "supermarkets": l.supermarkets, "stops": l.stops})


# ------------------------------------------------------------- spatial ---

@register("stops_near_schools", O.build(f"""
SELECT c.school_id, count(s.stop_id) AS stops_800m
FROM (SELECT school_id, lat, lon FROM stg_schools
      WHERE lat BETWEEN -37.5 AND -36.0 AND lon BETWEEN 174.0 AND 175.5) c
LEFT JOIN stg_stops s ON {O.distance_km('c.lat', 'c.lon', 's.lat', 's.lon')} < 0.8
GROUP BY c.school_id""", ["stg_schools", "stg_stops"]))
def q_stops_near_schools(spark, sf_dir):
    """One walking-distance centre per school (many more centres than suburbs)."""
    from tussock.functions.scores import WALK_RADIUS_KM
    from tussock.operators.spatial import count_within_distance
    l = landing(spark, sf_dir)
    schools = stg.stg_schools(l.schools).filter(
        F.col("lat").between(*stg.CENTROID_LAT_RANGE) & F.col("lon").between(*stg.CENTROID_LON_RANGE))
    centres = schools.select("school_id", F.col("lat").alias("centroid_lat"), F.col("lon").alias("centroid_lon"))
    return count_within_distance(centres, stg.stg_stops(l.stops), WALK_RADIUS_KM, centre_key="school_id",
                                 point_id="stop_id", out_col="stops_800m")


# ------------------------------------------------------ more reports / DQ ---

@register("report_suburb_choices", O.build(
    "SELECT DISTINCT suburb FROM mart_aff WHERE suburb IS NOT NULL ORDER BY suburb", ["mart_aff"]))
def q_suburb_choices(spark, sf_dir):
    from tussock.plans.reports import suburb_choices
    return suburb_choices(_mart(spark, sf_dir))


@register("report_header", O.build("""
SELECT count(DISTINCT suburb) AS n_suburbs, strftime(max(report_date), '%b %Y') AS latest_month
FROM mart_aff""", ["mart_aff"]))
def q_header(spark, sf_dir):
    from tussock.plans.reports import latest_label
    return latest_label(_mart(spark, sf_dir))


@register("dq_null_price_rows", O.build("""
SELECT * FROM stg_prices WHERE avg_sale_price IS NULL""", ["stg_prices"]))
def q_null_price_rows(spark, sf_dir):
    from tussock.operators.quality import null_rows
    return null_rows(stg.stg_prices(td.a_prices(spark, sf_dir)), ["avg_sale_price"])


@register("rate_sheet_rejects", O.build("""
SELECT _c0, _c1, _c7, _c9, _c17,
       CASE WHEN TRY_CAST(_c0 AS TIMESTAMP) IS NULL THEN 'bad_date'
            WHEN TRY_CAST(trim(_c1) AS DOUBLE) IS NULL THEN 'bad_ocr_rate' END AS reject_reason
FROM a_rate_sheet
WHERE TRY_CAST(_c0 AS TIMESTAMP) IS NULL OR TRY_CAST(trim(_c1) AS DOUBLE) IS NULL""", ["a_rate_sheet"]))
def q_rate_rejects(spark, sf_dir):
    """Rate-sheet rows that fail coercion, with the first failing reason (the
    accepted rows are what ``positional_projection`` keeps)."""
    from tussock.functions.cleaning import coerce_double, try_landing_date
    from tussock.operators.quality import split_rejects
    sheet = td.a_rate_sheet(spark, sf_dir).select("_c0", "_c1", "_c7", "_c9", "_c17")
    _, rejects = split_rejects(sheet, {"bad_date": try_landing_date("_c0").isNotNull(),
                                       "bad_ocr_rate": coerce_double("_c1").isNotNull()})
    return rejects


# ------------------------------------------------------ text-fed scans ---

def _csv_rows(lines, columns):
    """Rows of comma-separated lines, every column as text."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return lines.select(F.from_csv("line", schema).alias("r")).select("r.*")


@register("census_file_places", """
SELECT CASE WHEN k % 3 = 0 THEN 'Median age' ELSE 'Median household income' END AS section_title,
       ['Ponsonby', 'Remuera East', 'GREY LYNN', 'mission bay, upper', 'Old Mount Eden North (Auckland)'][k % 10 + 1] AS descriptor,
       CASE WHEN k % 5 = 1 THEN 'Count' ELSE 'Median' END AS value_type_description,
       CAST(k AS DOUBLE) AS value
FROM (SELECT c_custkey AS k FROM customer) c
WHERE k % 3 <> 2 AND k % 7 <> 0 AND k % 11 <> 0 AND k % 13 <> 0 AND k % 5 <> 0 AND k % 17 <> 0 AND k % 19 <> 0 AND k % 10 < 5""")
def q_census_file(spark, sf_dir):
    """The census export read as lines: header replaced, columns kept by name, areas
    matched with the literal list of place names."""
    from tussock.functions.cleaning import keep_columns
    from tussock.sources.ingest import ingest_census
    from tussock.sources.jobs import CENSUS_KEEP_COLUMNS
    from tussock.sources.landing import CENSUS_FILE_COLUMNS
    raw = keep_columns(_csv_rows(td.a_census_lines(spark, sf_dir), CENSUS_FILE_COLUMNS), CENSUS_KEEP_COLUMNS)
    raw = raw.withColumn("period", F.col("period").try_cast("int"))
    return ingest_census(raw).select("section_title", "descriptor", "value_type_description", "value")


@register("rate_sheet_lines", O.build("SELECT * FROM rates_positional", ["rates_positional"]))
def q_rate_lines(spark, sf_dir):
    """The headerless rate sheet read as lines, then picked by position."""
    from tussock.sources.ingest import rates_from_positions
    return rates_from_positions(_csv_rows(td.a_rate_lines(spark, sf_dir), [f"_c{i}" for i in range(18)]))


@register("school_records_envelope", O.build("""
SELECT s.school_id * 10 + o AS "School_Id", org_name AS "Org_Name", latitude AS "Latitude", status AS "Status"
FROM a_schools s, (VALUES (1), (2)) t(o) WHERE s.school_id % 9 <> 0""", ["a_schools"]))
def q_school_records(spark, sf_dir):
    from pyspark.sql import types as T

    from tussock.sources.payloads import envelope_schema, flatten_envelope
    record = T.StructType([T.StructField("School_Id", T.LongType()),
                           *[T.StructField(c, T.StringType()) for c in ("Org_Name", "Latitude", "Status")]])
    return flatten_envelope(td.a_school_payloads(spark, sf_dir), "payload",
                            envelope_schema(record, "records", outer="result"), "result.records")


@register("prices_text_export", O.build("""
SELECT suburb, district, strftime(report_date, '%Y-%m-%d %H:%M:%S') AS report_date,
       strftime(report_month, '%Y-%m-%d %H:%M:%S') AS report_month,
       avg_sale_price, avg_weekly_rent, gross_yield_pct, data_quality_flag, 'landed' AS source_name
FROM stg_prices""", ["stg_prices"]))
def q_prices_text(spark, sf_dir):
    """The text form of an export: every date as landing text, plus an audit column."""
    from tussock.functions.cleaning import datetimes_as_text, with_audit
    p = stg.stg_prices(td.a_prices(spark, sf_dir))
    return datetimes_as_text(with_audit(p, "source_name", F.lit("landed")))


# -------------------------------------------------------- report pages ---

@register("price_pages_extract", O.build("""
SELECT year, month, report_date, 'District ' || CAST(part % 4 AS VARCHAR) || ' & Co' AS district, 'Mt ' || CAST(k % 50 AS VARCHAR) AS suburb,
       CASE WHEN k % 19 <> 0 THEN CAST(1000000 + (100 + k % 900) * 1000 AS DOUBLE) END AS avg_sale_price,
       CAST(300 + k % 700 AS DOUBLE) AS avg_weekly_rent, CAST(k % 9 AS DOUBLE) + 0.5 AS gross_yield_pct
FROM report_orders JOIN report_page USING (year, month, report_date, part, idx)
WHERE state = 'ok' AND k % 13 <> 0 AND k % 17 <> 0
UNION ALL
SELECT year, month, report_date, 'Nest', suburb, price, rent, yield
FROM report_page, (VALUES ('Outer', 1.0::DOUBLE, 2.0::DOUBLE, 3.0::DOUBLE), ('Inner', 4.0::DOUBLE, 5.0::DOUBLE, 6.0::DOUBLE),
                          ('Inner', 4.0::DOUBLE, 5.0::DOUBLE, 6.0::DOUBLE)) n(suburb, price, rent, yield)
WHERE state = 'ok' AND idx % 3 = 0""", ["report_orders", "report_page"]))
def q_price_pages(spark, sf_dir):
    """Every month's report pages in one job, joined with the calendar of the orders' years."""
    from tussock.sources.calendar import calendar_grid
    from tussock.sources.ingest import ingest_price_pages
    from tussock.sources.jobs import REPORT_PATH_PATTERN
    from tussock.sources.landing import read_table
    o = read_table(spark, sf_dir, "orders")
    years = o.agg(F.year(F.min("o_orderdate")).alias("start_year"), F.year(F.max("o_orderdate")).alias("end_year"))
    return ingest_price_pages(td.a_report_pages(spark, sf_dir), calendar_grid(years), F.regexp_extract("url", REPORT_PATH_PATTERN, 1))


@register("price_pages_rejects", O.build("""
SELECT 'https://reports.example/' || CAST(year AS VARCHAR) || '/' || month || '/suburb-report?part=' || CAST(part AS VARCHAR) AS url,
       CASE WHEN state = 'ok' THEN 'no_rows' ELSE state END AS reason
FROM report_page p
WHERE state <> 'ok' OR idx % 3 <> 0 AND NOT EXISTS (
    SELECT 1 FROM report_orders o WHERE o.year = p.year AND o.month = p.month AND o.part = p.part AND k % 13 <> 0 AND k % 17 <> 0)""",
    ["report_orders", "report_page"]))
def q_price_rejects(spark, sf_dir):
    from tussock.sources.html import page_rejects
    return page_rejects(td.a_report_pages(spark, sf_dir), "url")


# ----------------------------------------------------- upkeep of the marts ---

@register("property_from_batches", O.build("SELECT * FROM property", ["property"]))
def q_property_batches(spark, sf_dir):
    """Two landing batches, each as stored state, merged: the same rows as from all prices at once."""
    from tussock.plans import upkeep
    p = stg.stg_prices(td.a_prices(spark, sf_dir))
    root = upkeep.work_folder(spark, "state")
    half = F.pmod(F.xxhash64(*p.columns), F.lit(2))
    states = [upkeep.stored_state(upkeep.price_state(p.filter(half == i)), f"{root}/{i}") for i in range(2)]
    return upkeep.property_of_state(upkeep.merged_state(*states))


def _landed_batches(spark, sf_dir):
    """Prices landed in two batches, one of them twice, and a third that was never finished."""
    from tussock.plans.upkeep import work_folder
    from tussock.sources import batches
    p, root = td.a_prices(spark, sf_dir), work_folder(spark, "batches")
    early, late = p.filter(F.col("report_date") < "1996"), p.filter(F.col("report_date") >= "1996")
    batches.land_batch(early, root, "early")
    batches.land_batch(late.limit(10), root, "late", attempt="1")
    batches.land_batch(late, root, "late", attempt="2")
    batches.write_batch(early, root, "broken", attempt="1")
    return root


@register("landing_retry_safe", O.build("""
SELECT *, CASE WHEN report_date < '1996' THEN 'early' ELSE 'late' END AS batch_id FROM a_prices""", ["a_prices"]))
def q_retry_safe(spark, sf_dir):
    from tussock.sources.batches import read_batches
    return read_batches(spark, _landed_batches(spark, sf_dir))


@register("landing_manifest", O.build("""
SELECT CASE WHEN report_date < '1996' THEN 'early' ELSE 'late' END AS batch_id,
       CASE WHEN report_date < '1996' THEN '1' ELSE '2' END AS attempt, count(*) AS row_count
FROM a_prices GROUP BY ALL""", ["a_prices"]))
def q_manifest(spark, sf_dir):
    from tussock.sources.batches import manifest
    return manifest(spark, _landed_batches(spark, sf_dir))


@register("stored_mart_below_peak", O.build("""
SELECT suburb, report_date, avg_sale_price, peak_price
FROM mart_aff JOIN (SELECT suburb, max(avg_sale_price) AS peak_price FROM mart_aff GROUP BY suburb) p USING (suburb)
WHERE year(report_date) >= 1998""", ["mart_aff"]))
def q_stored_mart(spark, sf_dir):
    """The mart stored by year and suburb bucket, read from one year on and joined with a table in the same buckets."""
    from tussock.plans import upkeep
    root = upkeep.work_folder(spark, "mart")
    mart, peaks = upkeep.store_mart(_mart(spark, sf_dir), root, root.rsplit("-", 1)[1])
    return upkeep.below_peak(mart, peaks, 1998)


# ------------------------------------------------------------ file scans ---

STOP_FILE_SCHEMA = "stop_id long, lat double, lon double, name string"
_STOP_LINES = """
SELECT k, lat, lon, CAST(k AS VARCHAR) || ',' || CASE WHEN k % 47 = 0 THEN 'north' ELSE lat END || ',' || lon
       || CASE WHEN k % 41 = 0 THEN '' WHEN k % 43 = 0 THEN ',"Stop, ' || k || '",?' ELSE ',"Stop, ' || k || '"' END AS line
FROM (SELECT o_orderkey AS k, CAST(CAST((-37500 + (o_orderkey * 7919) % 1499) / CAST(1000 AS DOUBLE) AS DECIMAL(9,3)) AS VARCHAR) AS lat,
             CAST(CAST((174000 + (o_orderkey * 104729) % 1493) / CAST(1000 AS DOUBLE) AS DECIMAL(9,3)) AS VARCHAR) AS lon FROM orders) o"""


def _stop_file(spark, sf_dir):
    """Stops written as delimited files with a header; some lines are short, long or hold no number. Returns the scan."""
    from pyspark.sql import types as T

    from tussock.plans.upkeep import work_folder
    from tussock.sources.scans import scan_delimited
    path = work_folder(spark, "stops")
    td.a_stop_lines(spark, sf_dir).write.text(path)
    return scan_delimited(spark, path, T.StructType.fromDDL(STOP_FILE_SCHEMA), header=False)


@register("stop_file_rows", f"""
SELECT k AS stop_id, CAST(lat AS DOUBLE) AS lat, CAST(lon AS DOUBLE) AS lon, 'Stop, ' || CAST(k AS VARCHAR) AS name
FROM ({_STOP_LINES}) l WHERE k % 41 <> 0 AND k % 43 <> 0 AND k % 47 <> 0""")
def q_stop_file(spark, sf_dir):
    from tussock.sources.scans import good_lines
    return good_lines(_stop_file(spark, sf_dir))


@register("stop_file_rejects", f"""
SELECT line, CASE WHEN k % 41 = 0 THEN 'short_line' WHEN k % 43 = 0 THEN 'long_line' ELSE 'bad_value' END AS reason,
       CAST(4 - CASE WHEN k % 41 = 0 THEN 1 ELSE 0 END - CASE WHEN k % 47 = 0 THEN 1 ELSE 0 END AS INTEGER) AS n_read
FROM ({_STOP_LINES}) l WHERE k % 41 = 0 OR k % 43 = 0 OR k % 47 = 0""")
def q_stop_rejects(spark, sf_dir):
    from tussock.sources.scans import bad_lines
    return bad_lines(_stop_file(spark, sf_dir), n_fields=4)


# ------------------------------------------------- frequent and distinct ---

@register("most_frequent_parts", """
SELECT l_partkey AS value, count(*) AS row_count FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY 1
QUALIFY rank() OVER (ORDER BY count(*) DESC) <= 20""")
def q_frequent_parts(spark, sf_dir):
    """Exact top 20 with ties, of many values that occur about as often."""
    from tussock.operators.frequent import most_frequent
    from tussock.sources.landing import read_table
    return most_frequent(read_table(spark, sf_dir, "lineitem"), "l_partkey", 20)


@register("most_frequent_districts", O.build("""
SELECT district AS value, count(*) AS row_count FROM stg_prices WHERE district IS NOT NULL GROUP BY 1
QUALIFY rank() OVER (ORDER BY count(*) DESC) <= 3""", ["stg_prices"]))
def q_frequent_districts(spark, sf_dir):
    """Exact top 3 of few values: the sketch names them, and they alone are counted."""
    from tussock.operators.frequent import most_frequent
    return most_frequent(stg.stg_prices(td.a_prices(spark, sf_dir)), "district", 3)


@register("distinct_customers_3y", """
WITH seen AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS y, o_custkey FROM orders)
SELECT p.y AS period, count(DISTINCT s.o_custkey) AS n_distinct, true AS within_bound
FROM (SELECT DISTINCT y FROM seen) p JOIN seen s ON s.y BETWEEN p.y - 2 AND p.y GROUP BY p.y""")
def q_distinct_customers(spark, sf_dir):
    """Distinct customers of three years: from stored sketches a year, merged, and exactly; both agree within the bound."""
    from tussock.operators import frequent
    from tussock.plans.upkeep import stored_state, work_folder
    from tussock.sources.landing import read_table
    o, year = read_table(spark, sf_dir, "orders"), F.year("o_orderdate")
    state = stored_state(frequent.distinct_state(o, "o_custkey", year), work_folder(spark, "sketches"))
    both = frequent.distinct_exactly(o, "o_custkey", year, 3).join(frequent.distinct_over(state, 3), "period")
    bound = F.lit(4 * frequent.DISTINCT_ERROR) * F.col("n_distinct") + 1
    return both.select("period", "n_distinct", (F.abs(F.col("estimate") - F.col("n_distinct")) <= bound).alias("within_bound"))


# ------------------------------------------------- branches of the marts ---

@register("price_carried_forward", O.build("""
SELECT suburb, report_month, quoted, last_value(quoted IGNORE NULLS) OVER (PARTITION BY suburb ORDER BY report_month) AS known
FROM (SELECT suburb, report_month, CASE WHEN month(report_month) % 4 = 2 THEN avg_sale_price END AS quoted FROM property) q""", ["property"]))
def q_carried_forward(spark, sf_dir):
    """Each suburb's last quoted price, carried over the months without one in two levels (years, then months)."""
    from tussock.operators.windows import carry_forward
    p = marts.property_by_suburb_month(stg.stg_prices(td.a_prices(spark, sf_dir)))
    quoted = p.select("suburb", "report_month", F.when(F.month("report_month") % 4 == 2, F.col("avg_sale_price")).alias("quoted"))
    return carry_forward(quoted, "quoted", "suburb", "report_month", "known", F.year("report_month"))


_PRICE_ORDER = ["report_date", "avg_sale_price", "avg_weekly_rent", "gross_yield_pct", "district"]


@register("latest_price_by_suburb", O.build(f"""
SELECT * FROM stg_prices QUALIFY row_number() OVER (PARTITION BY suburb ORDER BY {', '.join(c + ' DESC NULLS LAST' for c in _PRICE_ORDER)}) = 1""",
    ["stg_prices"]))
def q_latest_price(spark, sf_dir):
    """Keep-first on rows that repeat their suburb many times, at the same date too."""
    from tussock.operators.windows import keep_first
    p = stg.stg_prices(td.a_prices(spark, sf_dir))
    return keep_first(p, "suburb", [F.desc_nulls_last(c) for c in _PRICE_ORDER])


@register("amenity_scores_by_size", O.build("""
SELECT suburb, count(*) AS supermarket_count, CAST(least(10, 2 * count(*)) AS DOUBLE) AS amenity_score
FROM (SELECT 'area ' || CAST(length(bin(p_partkey)) AS VARCHAR) || CASE WHEN p_partkey % 5 = 0 THEN ' edge ' || CAST(p_partkey % 71 AS VARCHAR) ELSE '' END AS suburb
      FROM part) p GROUP BY 1""", []))
def q_amenity_sizes(spark, sf_dir):
    """Suburbs with few and many supermarkets: scores below the cap, and at it."""
    from tussock.sources.landing import read_table
    k = F.col("p_partkey")
    area = F.concat(F.lit("area "), F.length(F.bin(k)).cast("string"),
                    F.when(k % 5 == 0, F.concat(F.lit(" edge "), (k % 71).cast("string"))).otherwise(F.lit("")))
    return marts.amenity_scores(read_table(spark, sf_dir, "part").select(area.alias("suburb")))


@register("transit_scores_dense", f"""
WITH c AS (SELECT s_name AS suburb, -36.858 + (s_suppkey % 11) / 1000.0::DOUBLE AS lat, 174.76 + (s_suppkey % 7) / 30.0::DOUBLE AS lon FROM supplier),
     s AS (SELECT o_orderkey AS stop_id, -36.85 + (o_orderkey % 50) / 1000.0::DOUBLE AS lat, 174.76 + (o_orderkey % 300) / 2000.0::DOUBLE AS lon
           FROM orders WHERE o_orderkey % (1 + (o_orderkey % 300) // 10) = 0)
SELECT suburb, n AS transit_stops_800m, CAST(CASE WHEN n >= 30 THEN 10 ELSE round(CAST(n AS DECIMAL(20,0)) / 3.0, 6) END AS DOUBLE) AS transit_score
FROM (SELECT suburb, count(stop_id) AS n FROM c LEFT JOIN s ON {O.distance_km('c.lat', 'c.lon', 's.lat', 's.lon')} < 0.8 GROUP BY suburb) t""")
def q_transit_dense(spark, sf_dir):
    """Centres with no stop, some stops, and more than the score counts, on a street grid of stops that thins out to the east."""
    from tussock.sources.landing import read_table
    k, o = F.col("s_suppkey"), F.col("o_orderkey")
    centres = read_table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("suburb"), (F.lit(-36.858) + (k % 11) / F.lit(1000.0)).alias("centroid_lat"),
        (F.lit(174.76) + (k % 7) / F.lit(30.0)).alias("centroid_lon"))
    stops = read_table(spark, sf_dir, "orders").filter(o % (1 + F.floor((o % 300) / 10)) == 0).select(
        o.alias("stop_id"), (F.lit(-36.85) + (o % 50) / F.lit(1000.0)).alias("lat"), (F.lit(174.76) + (o % 300) / F.lit(2000.0)).alias("lon"))
    return marts.transit_scores(centres, stops)


@register("dq_mart_repeated_rows", O.build("""
SELECT suburb, report_date, count(*) AS row_count
FROM (SELECT suburb, report_date FROM mart_aff UNION ALL SELECT suburb, report_date FROM mart_aff WHERE year(report_date) = 1995) t
GROUP BY ALL HAVING count(*) > 1""", ["mart_aff"]))
def q_dq_repeated(spark, sf_dir):
    """The uniqueness check on a mart into which one year was loaded twice: it names every repeated key."""
    from tussock.operators.quality import duplicate_keys
    mart = _mart(spark, sf_dir).select("suburb", "report_date")
    return duplicate_keys(mart.unionByName(mart.filter(F.year("report_date") == 1995)), ["suburb", "report_date"])
