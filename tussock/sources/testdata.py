"""Landing-shaped relations derived from the TPC-H-like test tables.

Each ``a_*`` function reads the parquet tables under ``sf_dir`` and returns a
DataFrame shaped like one landing source (prices, rates, census, schools,
supermarkets, stops, money text, JSON envelopes, pages). The derivations are
deterministic integer arithmetic, so an independent SQL engine computes the
same rows (see ``tussock.plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tussock.sources.landing import read_table


def _fixed3(expr: Column) -> Column:
    """Integer thousandths -> text with exactly three decimals."""
    return (expr / F.lit(1000.0)).cast("decimal(9,3)").cast("string")


def _half(key: str) -> Column:
    """25 for every third key, else 0: splits the 25 nations into 50 suburbs."""
    return F.when(F.col(key) % 3 == 0, F.lit(25)).otherwise(F.lit(0))


def _midnight_text(d: Column) -> Column:
    return F.concat(d.cast("string"), F.lit(" 00:00:00"))


def a_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("o_orderkey")
    missing = (k % 97) == 0
    rent = (F.lit(300) + k % 700).cast("double")
    price = F.col("o_totalprice") * 12
    # One order in 16 is reported in the last month, so the latest snapshot has every suburb.
    month = F.when(k % 16 == 0, F.lit("2001-08-01").cast("date")).otherwise(F.trunc(F.col("o_orderdate"), "month"))
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .join(n, F.col("c_nationkey") == n.n_nationkey)
        .select(
            F.concat(F.lit("Mt "), (F.replace("n_name", F.lit("NATION_"), F.lit("")).cast("int") + _half("c_custkey")).cast("string"))
            .alias("suburb"),
            F.col("c_mktsegment").alias("district"),
            _midnight_text(month).alias("report_date"),
            F.when(missing, F.lit(None).cast("double")).otherwise(price).alias("avg_sale_price"),
            rent.alias("avg_weekly_rent"),
            # The published yield differs from the computed one by 0 to 4 percent.
            F.when(missing, F.lit(None).cast("double"))
            .otherwise(rent * 52 / price * (F.lit(100) + k % 5).cast("double")).alias("gross_yield_pct"),
        )
    )


def a_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select("l_shipdate")
    per_month = li.groupBy(F.trunc("l_shipdate", "month").alias("m")).agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    return per_month.select(
        _midnight_text(F.last_day(F.col("m"))).alias("date"),
        F.when(n % 19 == 0, F.lit(None).cast("double")).otherwise((n % 13).cast("double") / 2).alias("ocr_rate"),
        ((n % 17).cast("double") / 4).alias("swap_rate_2yr"),
        ((n % 11).cast("double") / 4).alias("bank_bill_90d"),
        ((n % 7).cast("double") / 4).alias("govt_bond_2yr"),
    )


def a_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    k = F.col("c_custkey")
    suffix = (
        F.when(k % 5 == 0, F.lit("")).when(k % 5 == 1, F.lit(" North"))
        .when(k % 5 == 2, F.lit(" (Auckland)")).when(k % 5 == 3, F.lit(" South East"))
        .otherwise(F.lit(" Central (Auckland)"))
    )
    # One nation's areas carry a longer name (found by a probe, not by the join key) and
    # another's none of the place names.
    area = (F.when(F.col("c_nationkey") == 3, F.lit("Lower Mount "))
            .when(F.col("c_nationkey") == 7, F.lit("Harbour ")).otherwise(F.lit("Mount ")))
    return c.select(
        F.when(k % 2 == 0, "Median household income").otherwise("Population").alias("section_title"),
        F.when(k % 11 == 0, "Territorial authority").otherwise("Statistical area 2").alias("classification_label"),
        F.concat(area, (F.col("c_nationkey") + _half("c_custkey")).cast("string"), suffix).alias("descriptor"),
        F.when(k % 13 == 0, 2018).otherwise(2023).alias("period"),
        F.when(k % 7 == 0, "Percent").otherwise("Median").alias("value_type_description"),
        F.when(k % 50 == 0, F.lit("..C"))
        .otherwise((F.lit(30000) + (k * 7919) % 90000).cast("string")).alias("value"),
    )


def a_schools(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    k = F.col("s_suppkey")
    return s.select(
        k.alias("school_id"),
        F.col("s_name").alias("org_name"),
        F.concat(F.lit("  Mount "), (F.col("s_nationkey") + _half("s_suppkey")).cast("string"), F.lit(" ")).alias("add1_suburb"),
        # Some schools lie outside the box for centroids, and some scores read NaN.
        F.when(k % 23 == 0, F.lit("n/a")).when(k % 7 == 0, F.lit("-38.100"))
        .otherwise(_fixed3(F.lit(-37500) + (k * 7919) % 1499)).alias("latitude"),
        F.when(k % 8 == 0, F.lit("176.250")).otherwise(_fixed3(F.lit(174000) + (k * 104729) % 1493)).alias("longitude"),
        F.when(k % 6 == 0, F.lit("NaN")).when(k % 11 == 0, F.lit("N/A")).otherwise((F.lit(344) + (k * 37) % 226).cast("string")).alias("eqi_index"),
        F.concat((F.lit(100) + k % 900).cast("string"), F.when(k % 4 == 0, F.lit(".0")).otherwise(F.lit(""))).alias("total"),
        F.when(k % 13 == 0, F.lit("Closed")).when(k % 17 == 0, F.lit(None).cast("string"))
        .otherwise(F.lit("Open")).alias("status"),
    )


def a_supermarkets(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    k = F.col("p_partkey")
    return p.select(
        k.alias("objectid"),
        F.concat(F.lit(" "), F.col("p_name"), F.lit(" ")).alias("name"),
        F.when(F.col("p_size") % 5 == 0, "Hamilton").otherwise("Auckland").alias("territorial_authority"),
        F.when(k % 6 == 0, F.lit("Mt Albert")).when(k % 6 == 1, F.lit("Oteha "))
        .when(k % 6 == 2, F.lit("Pinehill")).when(k % 6 == 3, F.lit(None).cast("string"))
        # Only even suburbs have a supermarket.
        .otherwise(F.concat(F.lit("Mount "), (k % 25 * 2).cast("string"))).alias("suburb"),
    )


def a_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("stop_id"),
        F.when(k % 101 == 0, F.lit(None).cast("string"))
        .otherwise(_fixed3(F.lit(-37500) + (k * 7919) % 1499)).alias("stop_lat"),
        _fixed3(F.lit(174000) + (k * 104729) % 1493).alias("stop_lon"),
        F.when(k % 29 == 0, F.lit(None).cast("long")).otherwise(k % 5).alias("location_type"),
    )


def a_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_size")
    k = F.col("p_partkey")
    return p.select(
        k.alias("id"),
        F.when(k % 17 == 0, F.lit("-")).otherwise(
            F.concat(F.lit(" $"), (F.lit(1) + k % 9).cast("string"), F.lit(","),
                     (F.lit(100) + k % 900).cast("string"), F.lit(",000 "))).alias("price_text"),
        F.concat(F.col("p_size").cast("string"), F.lit(".5%")).alias("yield_text"),
    )


def a_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events").select("event_id", "props")
    return e.select(
        "event_id",
        F.concat(F.lit('{"data":[{"id":'), F.col("event_id").cast("string"), F.lit(',"attributes":'),
                 F.col("props"), F.lit("}]}")).alias("payload"),
    )


def a_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return p.select(
        "page_id", "url",
        F.when(F.col("page_id") % 10 == 0, 404).otherwise(200).alias("status"),
        "html",
    )


def a_rate_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headerless 18-column rate spreadsheet export (all text): date in column 0,
    OCR in 1, 90-day bill in 7, 2-year bond in 9, 2-year swap in 17, filler
    elsewhere; some rows carry a text label instead of a date, and every fifth
    count of rows a date 25 years on, so that some lie past the patch."""
    li = read_table(spark, sf_dir, "lineitem").select("l_shipdate")
    per_month = li.groupBy(F.trunc("l_shipdate", "month").alias("m")).agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    cells = {
        0: F.when(n % 23 == 0, F.lit("Series")).otherwise(
            F.last_day(F.add_months(F.col("m"), F.when(n % 5 == 0, F.lit(300)).otherwise(F.lit(0)))).cast("string")),
        1: F.when(n % 19 == 0, F.lit("n/a")).otherwise(((n % 13).cast("double") / 2).cast("string")),
        7: ((n % 11).cast("double") / 4).cast("string"),
        9: ((n % 7).cast("double") / 4).cast("string"),
        17: ((n % 17).cast("double") / 4).cast("string"),
    }
    return per_month.select(*[cells.get(i, n.cast("string")).alias(f"_c{i}") for i in range(18)])


def a_supermarket_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supermarket file with its original (awkward) headers."""
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    base = a_supermarkets(spark, sf_dir).select("objectid", "suburb", "territorial_authority")
    j = p.join(base, p.p_partkey == base.objectid)
    return j.select(
        F.col("objectid").alias("OBJECTID"),
        F.col("p_name").alias("Name"),
        F.col("suburb").alias("Suburb"),
        F.col("p_brand").alias("Town - City"),
        F.col("territorial_authority").alias("Territorial Authority"),
        F.col("p_retailprice").alias("Shape__Area"),
        F.col("p_size").cast("double").alias("Shape__Length"),
    )


# Area names of the census file: the first five hold a listed place name, the rest don't.
CENSUS_FILE_AREAS = ["Ponsonby", "Remuera East", "GREY LYNN", "mission bay, upper", "Old Mount Eden North (Auckland)",
                     "Taupo Central", "Hamilton", "Lake Te Anau", "Wellington", "Ponsonb"]


def a_census_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the 22-column census export, as text (one column ``line``); the area name is
    quoted and may hold a comma, and every 11th is empty."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    area = F.element_at(F.array(*[F.lit(a) for a in CENSUS_FILE_AREAS]), (k % 10 + 1).cast("int"))
    cells = {
        "section_title": F.when(k % 3 == 0, "Median age").when(k % 3 == 1, "Median household income").otherwise("Dogs"),
        "classification_label": F.when(k % 7 == 0, "Region").otherwise("Statistical area 2"),
        "descriptor": F.when(k % 11 == 0, F.lit("")).otherwise(F.concat(F.lit('"'), area, F.lit('"'))),
        "period": F.when(k % 13 == 0, "2018").otherwise("2023"),
        "value_type_description": F.when(k % 5 == 0, "Percent").when(k % 5 == 1, "Count").otherwise("Median"),
        "value": F.when(k % 17 == 0, F.lit("..C")).when(k % 19 == 0, F.lit("NaN")).otherwise(k.cast("string")),
        "code": k.cast("string"),
    }
    from tussock.sources.landing import CENSUS_FILE_COLUMNS
    return c.select(F.concat_ws(",", *[cells.get(n, F.lit("x")) for n in CENSUS_FILE_COLUMNS]).alias("line"))


def a_rate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rate sheet as comma-separated lines without a header."""
    sheet = a_rate_sheet(spark, sf_dir)
    return sheet.select(F.concat_ws(",", *sheet.columns).alias("line"))


def a_school_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``{"result": {"records": [...]}}`` texts with two records each, or none."""
    s = a_schools(spark, sf_dir)

    def record(offset):
        return F.concat(F.lit('{"School_Id":'), (F.col("school_id") * 10 + offset).cast("string"), F.lit(',"Org_Name":"'),
                        F.col("org_name"), F.lit('","Latitude":"'), F.col("latitude"), F.lit('","Status":'),
                        F.coalesce(F.concat(F.lit('"'), F.col("status"), F.lit('"')), F.lit("null")), F.lit(',"Extra":[1]}'))
    records = F.when(F.col("school_id") % 9 == 0, F.lit("")).otherwise(F.concat(record(1), F.lit(","), record(2)))
    return s.select("school_id", F.concat(F.lit('{"help":"x","result":{"records":['), records, F.lit("]}}")).alias("payload"))


def a_report_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report pages (url, status, html), one a month and block of 2,000 order keys: a heading, then a table
    with a header row and a row an order. Some rows are short, some repeat the header's name and some have no
    price; some pages have a table before any heading, a nested table, no table, no row, or another status."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    k = F.col("o_orderkey")
    cells = (F.when(k % 17 == 0, F.lit("Suburb")).otherwise(F.concat(F.lit(" Mt "), (k % 50).cast("string"), F.lit(" "))),
             F.when(k % 19 == 0, F.lit("-")).otherwise(F.concat(F.lit("$1,"), (F.lit(100) + k % 900).cast("string"), F.lit(",000"))),
             F.concat(F.lit("<b>$"), (F.lit(300) + k % 700).cast("string"), F.lit("</b>")),
             F.concat((k % 9).cast("string"), F.lit(".5%")))
    row = F.when(k % 13 == 0, F.lit("<tr><td>Short</td><td>1</td></tr>")).otherwise(
        F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), c, F.lit("</td>")) for c in cells], F.lit("</tr>")))
    rows = o.select(F.trunc("o_orderdate", "month").alias("m"), F.floor(k / 2000).alias("part"), k.alias("k"), row.alias("row"))
    pages = rows.groupBy("m", "part").agg(F.array_sort(F.collect_list(F.struct("k", "row"))).alias("rows"))
    at = (F.year("m") * 12 + F.month("m") + F.col("part")).cast("long")
    body = F.array_join(F.transform("rows", lambda r: r["row"]), "")
    header = "<table><tr><td>Suburb</td><td>Price</td><td>Rent</td><td>Yield</td></tr>"
    early = "<table><tr><td>h</td></tr><tr><td>Lost</td><td>1</td><td>2</td><td>3</td></tr></table>"
    nested = ("<h3>Nest</h3><table><tr><td>head</td></tr><tr><td>Outer</td><td>$1</td><td>$2</td><td>3%</td><td><table>"
              "<tr><td>x</td></tr><tr><td>Inner</td><td>$4</td><td>$5</td><td>6%</td></tr></table></td></tr></table>")
    html = F.when(at % 11 == 0, F.lit("<html><body><p>none</p></body></html>")).otherwise(F.concat(
        F.lit("<html><body>"), F.when(at % 2 == 0, F.lit(early)).otherwise(F.lit("")),
        F.lit("<h3> District "), (F.col("part") % 4).cast("string"), F.lit(" &amp; Co</h3>" + header),
        F.when(at % 5 == 0, F.lit("")).otherwise(body), F.lit("</table>"),
        F.when((at % 3 == 0) & (at % 5 != 0), F.lit(nested)).otherwise(F.lit("")), F.lit("</body></html>")))
    url = F.concat(F.lit("https://reports.example/"), F.year("m").cast("string"), F.lit("/"), F.lower(F.date_format("m", "MMMM")),
                   F.lit("/suburb-report?part="), F.col("part").cast("string"))
    return pages.select(url.alias("url"), F.when(at % 7 == 0, 404).otherwise(200).alias("status"), html.alias("html"))


def a_stop_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stops as delimited lines (stop_id, lat, lon, quoted name): some short, some with a field too many, some without a number."""
    k = F.col("o_orderkey")
    lat, lon = _fixed3(F.lit(-37500) + (k * 7919) % 1499), _fixed3(F.lit(174000) + (k * 104729) % 1493)
    name = F.concat(F.lit(',"Stop, '), k.cast("string"), F.lit('"'))
    tail = F.when(k % 41 == 0, F.lit("")).when(k % 43 == 0, F.concat(name, F.lit(",?"))).otherwise(name)
    line = F.concat(k.cast("string"), F.lit(","), F.when(k % 47 == 0, F.lit("north")).otherwise(lat), F.lit(","), lon, tail)
    return read_table(spark, sf_dir, "orders").select(line.alias("line"))
