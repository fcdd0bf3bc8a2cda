"""Independent SQL oracle (DuckDB dialect) for every registered query.

Written as plain SQL over the pre-registered test tables, without reusing the
Spark code: named CTE blocks with declared dependencies are stitched into one
``WITH`` statement per query.

Rounding: Spark rounds a double via its shortest decimal text, half-up
(``round(1.005, 2) = 1.01``); DuckDB rounds the binary value. ``rnd`` casts
to DECIMAL first so both engines round the same decimal number.
"""

from __future__ import annotations

# --- Fixed values, restated here so that a slip in the engine's lists shows ---
CENSUS_METRICS = [
    "Median household income", "Median personal income of adults", "Population",
    "Households who own their home or hold in a family trust", "Median weekly rent paid by households",
    "Number of private dwellings", "Median age", "New Zealand index of socioeconomic deprivation",
    "Work and labour force status",
]
LOCALITY_SUFFIXES = [
    "central", "north", "south", "east", "west", "central-north", "central-south",
    "north east", "south east", "north west", "south west", "central east",
    "central north", "central south", "nirvana", "konini", "rosier", "woodglen",
    "larnoch", "keegan", "red hills", "seabrook", "tuff crater", "royal road west",
    "valley park", "abbotts park", "waiata", "waiatarua", "waitaramoa", "rosebank",
    "eastridge", "amaru", "oranga", "ferndale", "hamlin", "heights east",
    "heights north west", "heights south west", "mclennan", "massey park",
    "hospital", "eastburn", "south crossing", "hill east", "hill west",
    "parrs park", "industrial",
]
MARKET_ALIASES = {
    "mt albert": "mount albert", "mt roskill": "mount roskill", "mt wellington": "mount wellington",
    "mt eden": "mount eden", "auckland cbd": "city centre", "manukau city": "manukau",
    "manukau central": "manukau", "mangere central": "mangere", "botany downs": "botany",
    "takapuna north": "takapuna", "te atatu": "te atatu peninsula", "te atatu north": "te atatu peninsula",
    "murrays bay": "murrays bay", "the gardens": "flat bush", "dannemora": "east tamaki", "oteha": "albany",
    "pinehill": "albany", "clendon": "manurewa", "randwick park": "manurewa", "wattle downs": "manurewa",
}
PATCH = [
    ("2025-08-31", 2.75, 2.90, 3.30, 3.20),
    ("2025-09-30", 2.75, 2.85, 3.25, 3.10),
    ("2025-10-31", 2.75, 2.80, 3.20, 3.00),
    ("2025-11-30", 2.25, 2.50, 3.50, 3.45),
    ("2025-12-31", 2.25, 2.55, 3.70, 3.75),
    ("2026-01-31", 2.25, 2.60, 3.65, 3.70),
    ("2026-02-28", 2.25, 2.60, 3.60, 3.65),
    ("2026-03-31", 2.25, 2.60, 3.60, 3.65),
]
EARTH_KM = 6371.0
# --- end of fixed values ---


def distance_km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Great-circle distance from the chord between two points of the unit sphere."""
    def xyz(lat, lon):
        return (f"cos(radians({lat})) * cos(radians({lon}))", f"cos(radians({lat})) * sin(radians({lon}))", f"sin(radians({lat}))")
    chord2 = " + ".join(f"pow({a} - {b}, 2)" for a, b in zip(xyz(lat1, lon1), xyz(lat2, lon2)))
    return f"({2 * EARTH_KM} * asin(least(1, sqrt({chord2}) / 2)))"


def rnd(expr: str, n: int, digits: int = 9) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38,{digits})), {n}) AS DOUBLE)"


def dmean(expr: str) -> str:
    """Mean over exact decimals, ten decimals, as double (see reports.exact_mean)."""
    return f"CAST(round(avg(CAST({expr} AS DECIMAL(38,6))), 10) AS DOUBLE)"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in_list(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


_SUFFIX_RE = r"\s+(" + "|".join(LOCALITY_SUFFIXES) + r")$"
_ALIAS_CASE = (
    "CASE lower(trim(suburb)) "
    + " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in MARKET_ALIASES.items())
    + " ELSE lower(trim(suburb)) END"
)

# name -> (dependencies, SELECT body)
BLOCKS: dict[str, tuple[list[str], str]] = {}


def block(name: str, deps: list[str], body: str) -> None:
    BLOCKS[name] = (deps, body)


# ------------------------------------------------------------ adapters ---
block("a_prices", [], """
SELECT concat('Mt ', CAST(CAST(replace(n_name, 'NATION_', '') AS INTEGER) + CASE WHEN c_custkey % 3 = 0 THEN 25 ELSE 0 END AS VARCHAR)) AS suburb,
       c_mktsegment AS district,
       concat(CASE WHEN o_orderkey % 16 = 0 THEN '2001-08-01'
                   ELSE CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) END, ' 00:00:00') AS report_date,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_totalprice * 12 END AS avg_sale_price,
       CAST(300 + o_orderkey % 700 AS DOUBLE) AS avg_weekly_rent,
       CASE WHEN o_orderkey % 97 = 0 THEN NULL
            ELSE CAST(300 + o_orderkey % 700 AS DOUBLE) * 52 / (o_totalprice * 12) * CAST(100 + o_orderkey % 5 AS DOUBLE) END AS gross_yield_pct
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")

block("a_rates", [], """
SELECT concat(CAST(last_day(CAST(m AS DATE)) AS VARCHAR), ' 00:00:00') AS date,
       CASE WHEN n % 19 = 0 THEN NULL ELSE CAST(n % 13 AS DOUBLE) / 2 END AS ocr_rate,
       CAST(n % 17 AS DOUBLE) / 4 AS swap_rate_2yr,
       CAST(n % 11 AS DOUBLE) / 4 AS bank_bill_90d,
       CAST(n % 7 AS DOUBLE) / 4 AS govt_bond_2yr
FROM (SELECT date_trunc('month', l_shipdate) AS m, count(*) AS n FROM lineitem GROUP BY 1) t""")

block("a_census", [], """
SELECT CASE WHEN c_custkey % 2 = 0 THEN 'Median household income' ELSE 'Population' END AS section_title,
       CASE WHEN c_custkey % 11 = 0 THEN 'Territorial authority' ELSE 'Statistical area 2' END AS classification_label,
       concat(CASE c_nationkey WHEN 3 THEN 'Lower Mount ' WHEN 7 THEN 'Harbour ' ELSE 'Mount ' END,
              CAST(c_nationkey + CASE WHEN c_custkey % 3 = 0 THEN 25 ELSE 0 END AS VARCHAR),
              CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN ' North' WHEN 2 THEN ' (Auckland)'
                                 WHEN 3 THEN ' South East' ELSE ' Central (Auckland)' END) AS descriptor,
       CASE WHEN c_custkey % 13 = 0 THEN 2018 ELSE 2023 END AS period,
       CASE WHEN c_custkey % 7 = 0 THEN 'Percent' ELSE 'Median' END AS value_type_description,
       CASE WHEN c_custkey % 50 = 0 THEN '..C'
            ELSE CAST(30000 + (c_custkey * 7919) % 90000 AS VARCHAR) END AS value
FROM customer""")

block("a_schools", [], """
SELECT s_suppkey AS school_id,
       s_name AS org_name,
       concat('  Mount ', CAST(s_nationkey + CASE WHEN s_suppkey % 3 = 0 THEN 25 ELSE 0 END AS VARCHAR), ' ') AS add1_suburb,
       CASE WHEN s_suppkey % 23 = 0 THEN 'n/a' WHEN s_suppkey % 7 = 0 THEN '-38.100'
            ELSE CAST(CAST((-37500 + (s_suppkey * 7919) % 1499) / CAST(1000 AS DOUBLE) AS DECIMAL(9,3)) AS VARCHAR) END AS latitude,
       CASE WHEN s_suppkey % 8 = 0 THEN '176.250'
            ELSE CAST(CAST((174000 + (s_suppkey * 104729) % 1493) / CAST(1000 AS DOUBLE) AS DECIMAL(9,3)) AS VARCHAR) END AS longitude,
       CASE WHEN s_suppkey % 6 = 0 THEN 'NaN' WHEN s_suppkey % 11 = 0 THEN 'N/A' ELSE CAST(344 + (s_suppkey * 37) % 226 AS VARCHAR) END AS eqi_index,
       concat(CAST(100 + s_suppkey % 900 AS VARCHAR), CASE WHEN s_suppkey % 4 = 0 THEN '.0' ELSE '' END) AS total,
       CASE WHEN s_suppkey % 13 = 0 THEN 'Closed' WHEN s_suppkey % 17 = 0 THEN NULL ELSE 'Open' END AS status
FROM supplier""")

block("a_supermarkets", [], """
SELECT p_partkey AS objectid,
       concat(' ', p_name, ' ') AS name,
       CASE WHEN p_size % 5 = 0 THEN 'Hamilton' ELSE 'Auckland' END AS territorial_authority,
       CASE p_partkey % 6 WHEN 0 THEN 'Mt Albert' WHEN 1 THEN 'Oteha ' WHEN 2 THEN 'Pinehill' WHEN 3 THEN NULL
                          ELSE concat('Mount ', CAST(p_partkey % 25 * 2 AS VARCHAR)) END AS suburb
FROM part""")

block("a_stops", [], """
SELECT o_orderkey AS stop_id,
       CASE WHEN o_orderkey % 101 = 0 THEN NULL
            ELSE CAST(CAST((-37500 + (o_orderkey * 7919) % 1499) / CAST(1000 AS DOUBLE) AS DECIMAL(9,3)) AS VARCHAR) END AS stop_lat,
       CAST(CAST((174000 + (o_orderkey * 104729) % 1493) / CAST(1000 AS DOUBLE) AS DECIMAL(9,3)) AS VARCHAR) AS stop_lon,
       CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE o_orderkey % 5 END AS location_type
FROM orders""")

block("a_money", [], """
SELECT p_partkey AS id,
       CASE WHEN p_partkey % 17 = 0 THEN '-'
            ELSE concat(' $', CAST(1 + p_partkey % 9 AS VARCHAR), ',', CAST(100 + p_partkey % 900 AS VARCHAR), ',000 ') END AS price_text,
       concat(CAST(p_size AS VARCHAR), '.5%') AS yield_text
FROM part""")

block("a_envelope", [], """
SELECT event_id,
       concat('{"data":[{"id":', CAST(event_id AS VARCHAR), ',"attributes":', props, '}]}') AS payload
FROM events""")

block("a_pages", [], """
SELECT page_id, url, CASE WHEN page_id % 10 = 0 THEN 404 ELSE 200 END AS status, html
FROM pages""")

# ------------------------------------------------------------- landing ---
block("place_keywords", [], """
SELECT DISTINCT replace(n_name, 'NATION_', 'Mount ') AS keyword FROM nation""")

block("l_census", ["a_census", "place_keywords"], f"""
SELECT section_title, classification_label, descriptor, period, value_type_description,
       TRY_CAST(trim(value) AS DOUBLE) AS value
FROM a_census
WHERE classification_label = 'Statistical area 2' AND period = 2023
  AND section_title IN {_in_list(CENSUS_METRICS)}
  AND EXISTS (SELECT 1 FROM place_keywords k WHERE contains(lower(descriptor), lower(k.keyword)))
  AND value_type_description IN ('Median', 'Count')
  AND TRY_CAST(trim(value) AS DOUBLE) IS NOT NULL
  AND NOT isnan(TRY_CAST(trim(value) AS DOUBLE))""")

block("l_supermarkets", ["a_supermarkets"], """
SELECT * FROM a_supermarkets WHERE territorial_authority = 'Auckland'""")

# ------------------------------------------------------------- staging ---
block("stg_prices", ["a_prices"], """
SELECT suburb, district,
       CAST(strptime(report_date, '%Y-%m-%d %H:%M:%S') AS DATE) AS report_date,
       CAST(date_trunc('month', CAST(strptime(report_date, '%Y-%m-%d %H:%M:%S') AS DATE)) AS DATE) AS report_month,
       avg_sale_price, avg_weekly_rent, gross_yield_pct,
       CASE WHEN avg_sale_price IS NULL THEN 'missing_price'
            WHEN avg_sale_price < 200000 THEN 'suspect_low'
            WHEN avg_sale_price > 5000000 THEN 'suspect_high'
            ELSE 'ok' END AS data_quality_flag
FROM a_prices""")

block("stg_rates", ["a_rates"], """
SELECT CAST(strptime(date, '%Y-%m-%d %H:%M:%S') AS DATE) AS rate_date,
       CAST(date_trunc('month', CAST(strptime(date, '%Y-%m-%d %H:%M:%S') AS DATE)) AS DATE) AS rate_month,
       CAST(ocr_rate AS DOUBLE) AS ocr_rate,
       CAST(swap_rate_2yr AS DOUBLE) AS swap_rate_2yr,
       CAST(bank_bill_90d AS DOUBLE) AS bank_bill_90d,
       CAST(govt_bond_2yr AS DOUBLE) AS govt_bond_2yr
FROM a_rates
WHERE ocr_rate IS NOT NULL""")

block("stg_census_income", ["l_census"], f"""
SELECT trim(regexp_replace(regexp_replace(lower(descriptor), '\\s*\\([^)]*\\)$', ''), '{_SUFFIX_RE}', '')) AS suburb,
       {rnd('avg(CAST(value AS DOUBLE))', 0)} AS median_household_income
FROM l_census
WHERE section_title = 'Median household income' AND value_type_description = 'Median' AND value IS NOT NULL
GROUP BY 1""")

block("stg_schools", ["a_schools"], """
SELECT school_id,
       org_name AS school_name,
       CAST(NULL AS VARCHAR) AS school_type,
       CAST(NULL AS VARCHAR) AS authority,
       CAST(NULL AS VARCHAR) AS sa2_code,
       CAST(NULL AS VARCHAR) AS sa2_name,
       lower(trim(add1_suburb)) AS suburb,
       CAST(NULL AS VARCHAR) AS city,
       CAST(NULL AS VARCHAR) AS territorial_authority,
       TRY_CAST(latitude AS DOUBLE) AS lat,
       TRY_CAST(longitude AS DOUBLE) AS lon,
       CASE WHEN eqi_index <> 'NaN' THEN TRY_CAST(eqi_index AS DOUBLE) END AS eqi_index,
       TRY_CAST(round(TRY_CAST(total AS DOUBLE)) AS INTEGER) AS roll,
       status
FROM a_schools
WHERE status != 'Closed' AND latitude IS NOT NULL""")

block("stg_supermarkets", ["l_supermarkets"], f"""
SELECT objectid AS supermarket_id,
       lower(trim(name)) AS supermarket_name,
       {_ALIAS_CASE} AS suburb
FROM l_supermarkets
WHERE suburb IS NOT NULL""")

block("stg_stops", ["a_stops"], """
SELECT stop_id,
       CAST(NULL AS VARCHAR) AS stop_code,
       CAST(NULL AS VARCHAR) AS stop_name,
       CAST(stop_lat AS DOUBLE) AS lat,
       CAST(stop_lon AS DOUBLE) AS lon,
       CAST(location_type AS INTEGER) AS location_type,
       CASE location_type WHEN 0 THEN 'stop' WHEN 1 THEN 'station' WHEN 2 THEN 'entrance' ELSE 'other' END AS stop_type,
       CAST(NULL AS VARCHAR) AS parent_station
FROM a_stops
WHERE stop_lat IS NOT NULL AND stop_lon IS NOT NULL""")

block("suburb_centroids", ["stg_schools"], """
SELECT suburb, avg(lat) AS centroid_lat, avg(lon) AS centroid_lon, count(*) AS school_count_for_centroid
FROM stg_schools
WHERE lat BETWEEN -37.5 AND -36.0 AND lon BETWEEN 174.0 AND 175.5
GROUP BY suburb
HAVING count(*) >= 1""")

# --------------------------------------------------------------- marts ---
# Plausible prices by the range itself (a plausible price has the flag 'ok').
block("property", ["stg_prices"], f"""
SELECT suburb, report_month, max(report_date) AS report_date,
       {rnd('avg(CAST(avg_sale_price AS DECIMAL(38,6)))', 0)} AS avg_sale_price,
       {rnd('avg(avg_weekly_rent)', 0)} AS avg_weekly_rent,
       {rnd('avg(gross_yield_pct)', 2)} AS gross_yield_pct,
       'ok' AS data_quality_flag
FROM stg_prices WHERE avg_sale_price >= 200000 AND avg_sale_price <= 5000000 GROUP BY ALL""")

# Everything known of a suburb, one row a key: three sources stacked, then folded.
block("suburb_facts", ["stg_census_income", "stg_schools", "stg_supermarkets"], """
SELECT place, max(income) AS income, max(schools) AS schools, max(eqi) AS eqi, max(markets) AS markets
FROM (SELECT suburb AS place, median_household_income AS income,
             CAST(NULL AS BIGINT) AS schools, CAST(NULL AS DOUBLE) AS eqi, CAST(NULL AS BIGINT) AS markets
      FROM stg_census_income
      UNION ALL BY NAME SELECT suburb AS place, count(*) AS schools, avg(eqi_index) AS eqi FROM stg_schools GROUP BY suburb
      UNION ALL BY NAME SELECT suburb AS place, count(*) AS markets FROM stg_supermarkets GROUP BY suburb) AS stacked
GROUP BY place""")

block("mart_aff", ["property", "suburb_facts", "stg_rates"], f"""
WITH keyed AS (SELECT *, replace(lower(trim(suburb)), 'mt ', 'mount ') AS place FROM property),
     told AS (SELECT keyed.*, income, schools, eqi, markets, avg_sale_price / NULLIF(income, 0) AS years_of_income
              FROM keyed LEFT JOIN suburb_facts USING (place))
SELECT told.suburb, told.report_date, avg_sale_price, avg_weekly_rent, gross_yield_pct,
       income AS median_household_income, ocr_rate, swap_rate_2yr,
       schools AS school_count, {rnd('eqi', 1)} AS avg_eqi_index, markets AS supermarket_count,
       {rnd('years_of_income', 2)} AS price_to_income_ratio,
       {rnd('years_of_income * (1 + swap_rate_2yr / 100)', 2)} AS affordability_index
FROM told LEFT JOIN stg_rates ON rate_month = report_month""")

block("int_school_scores", ["suburb_facts"], f"""
SELECT place AS suburb, schools AS school_count, {rnd('eqi', 2)} AS avg_eqi_index,
       CASE WHEN eqi IS NOT NULL THEN {rnd('CASE WHEN eqi < 344 THEN 0 WHEN eqi > 569 THEN 10 ELSE (eqi - 344) / 22.5 END', 2)} END AS school_score
FROM suburb_facts WHERE schools IS NOT NULL""")

block("int_supermarket_scores", ["suburb_facts"], """
SELECT place AS suburb, markets AS supermarket_count,
       CAST(CASE WHEN markets >= 5 THEN 10 ELSE 2 * markets END AS DOUBLE) AS amenity_score
FROM suburb_facts WHERE markets IS NOT NULL""")

block("int_transit_scores", ["suburb_centroids", "stg_stops"], f"""
SELECT suburb, n AS transit_stops_800m, CAST(CASE WHEN n >= 30 THEN 10 ELSE round(CAST(n AS DECIMAL(20,0)) / 3.0, 6) END AS DOUBLE) AS transit_score
FROM (SELECT suburb, (SELECT count(stop_id) FROM stg_stops
                      WHERE {distance_km('centroid_lat', 'centroid_lon', 'lat', 'lon')} < 0.8) AS n
      FROM suburb_centroids) AS walked""")

block("mart_live", ["suburb_centroids", "int_transit_scores", "int_school_scores", "int_supermarket_scores"], f"""
WITH scored AS (
    SELECT suburb, centroid_lat, centroid_lon, transit_stops_800m, transit_score, school_count, avg_eqi_index, school_score,
           supermarket_count, amenity_score
    FROM suburb_centroids LEFT JOIN int_transit_scores USING (suburb) LEFT JOIN int_school_scores USING (suburb)
         LEFT JOIN int_supermarket_scores USING (suburb))
SELECT *, {rnd('ifnull(0.45 * transit_score, 0) + ifnull(0.40 * school_score, 0) + ifnull(0.15 * amenity_score, 0)', 2)} AS liveability_score
FROM scored""")


def build(final_select: str, needs: list[str]) -> str:
    """WITH <needed blocks in dependency order> <final_select>."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in BLOCKS[n][0]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return final_select.strip()
    ctes = ",\n".join(f"{n} AS ({BLOCKS[n][1].strip()})" for n in order)
    return f"WITH {ctes}\n{final_select.strip()}"




# ----------------------------------------------------- source-job blocks ---
block("a_rate_sheet", [], """
SELECT CASE WHEN n % 23 = 0 THEN 'Series' ELSE CAST(last_day(CAST(m AS DATE) + CASE WHEN n % 5 = 0 THEN INTERVAL 300 MONTH ELSE INTERVAL 0 MONTH END) AS VARCHAR) END AS _c0,
       CASE WHEN n % 19 = 0 THEN 'n/a' ELSE CAST(CAST(n % 13 AS DOUBLE) / 2 AS VARCHAR) END AS _c1,
       CAST(CAST(n % 11 AS DOUBLE) / 4 AS VARCHAR) AS _c7,
       CAST(CAST(n % 7 AS DOUBLE) / 4 AS VARCHAR) AS _c9,
       CAST(CAST(n % 17 AS DOUBLE) / 4 AS VARCHAR) AS _c17
FROM (SELECT date_trunc('month', l_shipdate) AS m, count(*) AS n FROM lineitem GROUP BY 1) t""")

block("rates_positional", ["a_rate_sheet"], """
SELECT CAST(TRY_CAST(_c0 AS TIMESTAMP) AS DATE) AS date,
       TRY_CAST(trim(_c1) AS DOUBLE) AS ocr_rate,
       TRY_CAST(trim(_c7) AS DOUBLE) AS bank_bill_90d,
       TRY_CAST(trim(_c9) AS DOUBLE) AS govt_bond_2yr,
       TRY_CAST(trim(_c17) AS DOUBLE) AS swap_rate_2yr
FROM a_rate_sheet
WHERE TRY_CAST(_c0 AS TIMESTAMP) IS NOT NULL""")

block("rate_patch", [], "SELECT * FROM (VALUES " + ", ".join(
    f"(DATE '{d}', CAST({a} AS DOUBLE), CAST({b} AS DOUBLE), CAST({c} AS DOUBLE), CAST({e} AS DOUBLE))"
    for d, a, b, c, e in PATCH) + ") AS t(date, ocr_rate, bank_bill_90d, govt_bond_2yr, swap_rate_2yr)")

block("rates_patched", ["rates_positional", "rate_patch"], """
SELECT * FROM rates_positional WHERE date < (SELECT min(date) FROM rate_patch)
UNION ALL
SELECT * FROM rate_patch""")

block("a_supermarket_file", ["a_supermarkets"], """
SELECT s.objectid AS "OBJECTID", p_name AS "Name", s.suburb AS "Suburb", p_brand AS "Town - City",
       s.territorial_authority AS "Territorial Authority", p_retailprice AS "Shape__Area",
       CAST(p_size AS DOUBLE) AS "Shape__Length"
FROM part JOIN a_supermarkets s ON p_partkey = s.objectid""")

block("mart_keys", ["property"], f"""
SELECT DISTINCT replace(lower(trim(suburb)), 'mt ', 'mount ') AS suburb_key FROM property
WHERE suburb IS NOT NULL""")

block("coverage_unmatched", ["mart_keys", "stg_census_income", "stg_schools", "stg_supermarkets"], """
SELECT 'census' AS source, suburb_key FROM mart_keys
WHERE suburb_key NOT IN (SELECT suburb FROM stg_census_income WHERE suburb IS NOT NULL)
UNION ALL
SELECT 'schools' AS source, suburb_key FROM mart_keys
WHERE suburb_key NOT IN (SELECT suburb FROM stg_schools WHERE suburb IS NOT NULL)
UNION ALL
SELECT 'supermarkets' AS source, suburb_key FROM mart_keys
WHERE suburb_key NOT IN (SELECT suburb FROM stg_supermarkets WHERE suburb IS NOT NULL)""")

block("rate_cycle", ["mart_aff"], f"""
SELECT report_date, avg(avg_sale_price) AS avg_sale_price, {dmean('ocr_rate')} AS ocr_rate
FROM mart_aff WHERE report_date IS NOT NULL GROUP BY report_date""")

block("recent", ["mart_aff"], """
SELECT * FROM mart_aff
WHERE report_date >= CAST((SELECT max(report_date) FROM mart_aff) - INTERVAL 2 MONTH AS DATE)""")

block("census_marked", ["a_census", "place_keywords"], f"""
SELECT coalesce(classification_label = 'Statistical area 2' AND period = 2023, false) AS s1,
       coalesce(section_title IN {_in_list(CENSUS_METRICS)}, false) AS s2,
       EXISTS (SELECT 1 FROM place_keywords k WHERE contains(lower(descriptor), lower(k.keyword))) AS s3,
       coalesce(value_type_description IN ('Median', 'Count'), false) AS s4,
       coalesce(TRY_CAST(trim(value) AS DOUBLE) IS NOT NULL AND NOT isnan(TRY_CAST(trim(value) AS DOUBLE)), false) AS s5
FROM a_census""")

block("mart_null_counts", ["mart_aff"], """
SELECT 'report_date' AS column_name, count(*) FILTER (WHERE report_date IS NULL) AS failing_rows FROM mart_aff
UNION ALL SELECT 'suburb', count(*) FILTER (WHERE suburb IS NULL) FROM mart_aff
UNION ALL SELECT 'avg_sale_price', count(*) FILTER (WHERE avg_sale_price IS NULL) FROM mart_aff""")

# Text blocks under headings, by regular expressions: every block boundary
# (start of p/h1-h6/div/..., end of div/article/...) first gets an explicit
# '</p>' so an unclosed <p> ends where HTML would end it; then headings and
# paragraphs are extracted in document order, tags split out, the entities that
# occur decoded, pieces stripped and concatenated (get_text(strip=True)).
_BOUNDARY = (r"(<(?:p|h[1-6]|div|article|section|footer|header|nav|ul|ol|table|main|aside)[\s>/]"
             r"|</(?:div|article|section|footer|header|nav|ul|ol|table|main|aside|body|html)>)")
# Legacy named references decode with or without the trailing ';', as in an
# HTML parser; '&amp' goes last so '&amp;lt;' stays '&lt;'.
_ENTITIES = [("lt", "'<'"), ("gt", "'>'"), ("quot", "chr(34)"), ("#39", "chr(39)"), ("nbsp", "chr(160)"),
             ("copy", "chr(169)"), ("middot", "chr(183)"), ("amp", "'&'")]
_DECODE = "x"
for _name, _char in _ENTITIES:
    _DECODE = f"regexp_replace({_DECODE}, '&{_name};?', {_char}, 'g')"
_STRIP = r"regexp_replace(" + _DECODE + r", '^[\s\x{00a0}]+|[\s\x{00a0}]+$', '', 'g')"
block("page_blocks", ["a_pages"], f"""
SELECT page_id, url, pos, kind, heading, text FROM (
  SELECT page_id, url, pos, kind, text,
         last_value(CASE WHEN kind = 'heading' THEN text END IGNORE NULLS)
           OVER (PARTITION BY page_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS heading
  FROM (
    SELECT page_id, url, CAST(pos - 1 AS INTEGER) AS pos,
           CASE WHEN lower(e) LIKE '<h1%' THEN 'heading' ELSE 'block' END AS kind,
           array_to_string(list_filter(list_transform(
               regexp_split_to_array(regexp_extract(e, '(?s)^<[^>]*>(.*)</[^>]*>$', 1), '<[^>]*>'),
               lambda x: {_STRIP}), lambda x: x <> ''), '') AS text
    FROM (
      SELECT page_id, url, unnest(l) AS e, generate_subscripts(l, 1) AS pos
      FROM (SELECT page_id, url,
                   regexp_extract_all(regexp_replace(html, '{_BOUNDARY}', '</p>\\1', 'g'),
                                      '(?is)<h1(?:\\s[^>]*)?>.*?</h1>|<p(?:\\s[^>]*)?>.*?</p>') AS l
            FROM a_pages WHERE status = 200) x) y) z) w""")


# Report pages: what the derived pages must give, straight from the orders.
block("report_orders", [], """
SELECT o_orderkey AS k, o_orderkey // 2000 AS part, CAST(year(o_orderdate) AS INTEGER) AS year, lower(monthname(o_orderdate)) AS month,
       strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') || ' 00:00:00' AS report_date,
       year(o_orderdate) * 12 + month(o_orderdate) + o_orderkey // 2000 AS idx
FROM orders""")

block("report_page", ["report_orders"], """
SELECT DISTINCT year, month, report_date, part, idx,
       CASE WHEN idx % 7 = 0 THEN 'http_404' WHEN idx % 11 = 0 THEN 'no_content' WHEN idx % 5 = 0 THEN 'no_rows' ELSE 'ok' END AS state
FROM report_orders""")
