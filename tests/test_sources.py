import datetime as dt
import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tussock.sources import html as H
from tussock.sources.calendar import calendar_grid, month_start
from tussock.sources.ingest import (
    census_funnel, ingest_census, ingest_supermarket_file, patch_union, rate_patch, rates_from_positions,
)
from tussock.sources.landing import (
    preamble_dictionary, read_census_file, read_delimited, read_headerless, read_json_records,
)

REPORT_HTML = """
<table><tr><th>Suburb</th></tr><tr><td>Lost</td><td>$1</td><td>$1</td><td>1%</td></tr></table>
<h3> North Shore </h3>
<table><tr><th>Suburb</th><th>Price</th><th>Rent</th><th>Yield</th></tr>
<tr><td>Albany</td><td>$1,234,000</td><td>$700</td><td>3.1%</td></tr>
<tr><td>Short</td><td>$1</td></tr>
<tr><td>AREA</td><td>$1</td><td>$1</td><td>1%</td></tr>
<tr><td>Milford</td><td>-</td><td>$650</td><td></td></tr></table>
<h3>West</h3>
<table><tr><td>Header</td></tr><tr><td>Swanson</td><td>$800,000</td><td>$600</td><td>3.9%</td></tr></table>
"""


def test_html_report_tables(spark):
    pages = spark.createDataFrame([(1, REPORT_HTML), (2, "<p>nothing</p>"), (3, None)], "page_id long, html string")
    rows = H.report_rows(pages, "page_id").orderBy("district", "suburb").collect()
    got = [(r.district, r.suburb, r.avg_sale_price, r.avg_weekly_rent, r.gross_yield_pct) for r in rows]
    assert got == [("North Shore", "Albany", 1234000.0, 700.0, 3.1), ("North Shore", "Milford", None, 650.0, None),
                   ("West", "Swanson", 800000.0, 600.0, 3.9)]


def test_html_blocks_follow_last_heading(spark):
    html = "<p>before</p><h1>A &amp; B</h1><p>one <b>bold</b></p><script>var t='</p>';</script><h1>C</h1><p> two </p>"
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    got = [(r.heading, r.text) for r in H.heading_blocks(pages, "page_id", "h1", "p").orderBy("block_pos").collect()]
    assert got == [("A & B", "onebold"), ("C", "two")]


def test_triage(spark):
    pages = spark.createDataFrame([(1, 200, "<table></table>"), (2, 404, "<table>"), (3, 200, "<p>x</p>")],
                                  "page_id long, status int, html string")
    got = {r.page_id: r.reason for r in H.triage(pages).collect()}
    assert got == {1: "ok", 2: "http_404", 3: "no_content"}


def test_patch_union_replaces_tail(spark):
    schema = "date date, ocr_rate double, bank_bill_90d double, govt_bond_2yr double, swap_rate_2yr double"
    base = spark.createDataFrame([(dt.date.fromisoformat(d), 1.0, 1.0, 1.0, 1.0)
                                  for d in ["2025-07-31", "2025-08-31", "2025-12-31", "2026-06-30"]], schema)
    patch = spark.createDataFrame([(dt.date.fromisoformat(d), 2.0, 2.0, 2.0, 2.0)
                                   for d in ["2025-08-31", "2025-09-30"]], schema)
    got = [(str(r.date), r.ocr_rate) for r in patch_union(base, patch).orderBy("date").collect()]
    assert got == [("2025-07-31", 1.0), ("2025-08-31", 2.0), ("2025-09-30", 2.0)]


def test_reference_patch_rows(spark):
    p = rate_patch(spark).orderBy("date").collect()
    assert len(p) == 8 and str(p[0].date) == "2025-08-31" and p[-1].swap_rate_2yr == 3.65


def test_rate_sheet_positions_and_preamble(spark, tmp_dir):
    path = os.path.join(tmp_dir, "rates.csv")
    rows = [",".join(["Series"] + [f"h{i}" for i in range(1, 18)]),
            ",".join(["Units"] + ["%"] * 17),
            ",".join(["2001-01-31", "6.5"] + ["0"] * 5 + ["6.1", "0", "5.9"] + ["0"] * 7 + ["6.3"]),
            ",".join(["2001-02-28", "n/a"] + ["0"] * 5 + ["6.0", "0", "5.8"] + ["0"] * 7 + ["6.2"])]
    with open(path, "w") as f:
        f.write("\n".join(rows) + "\n")
    raw = read_headerless(spark, path, 18)
    got = [tuple(r) for r in rates_from_positions(raw).orderBy("date").collect()]
    assert got == [(dt.date(2001, 1, 31), 6.5, 6.1, 5.9, 6.3), (dt.date(2001, 2, 28), None, 6.0, 5.8, 6.2)]
    d = {r.col_idx: (r.label_0, r.label_1) for r in preamble_dictionary(spark, path).collect()}
    assert d[0] == ("Series", "Units") and d[17] == ("h17", "%")


def test_census_file_scan_and_ingest(spark, tmp_dir):
    from tussock.sources.landing import CENSUS_FILE_COLUMNS
    path = os.path.join(tmp_dir, "census.csv")

    def line(title, level, descriptor, period, vtype, value):
        cells = dict.fromkeys(CENSUS_FILE_COLUMNS, "")
        cells.update(section_title=title, classification_label=level, descriptor=descriptor, period=str(period),
                     value_type_description=vtype, value=value)
        return ",".join(cells[c] for c in CENSUS_FILE_COLUMNS)

    rows = ["ignored header " + ",x" * 21,
            line("Median household income", "Statistical area 2", "Ponsonby East", 2023, "Median", "91000"),
            line("Median household income", "Statistical area 2", "Hamilton Central", 2023, "Median", "70000"),
            line("Median household income", "Statistical area 2", "Remuera North", 2018, "Median", "99000"),
            line("Median household income", "Statistical area 2", "Remuera South", 2023, "Median", "..C"),
            line("Median household income", "Statistical area 2", "Epsom", 2023, "Percent", "12")]
    with open(path, "w") as f:
        f.write("\n".join(rows) + "\n")
    raw = read_census_file(spark, path, keep=["section_title", "classification_label", "descriptor", "period",
                                              "value_type_description", "value"])
    raw = raw.withColumn("period", F.col("period").cast("int"))
    got = [(r.descriptor, r.value) for r in ingest_census(raw).collect()]
    assert got == [("Ponsonby East", 91000.0)]
    funnel = [r.row_count for r in census_funnel(raw).orderBy("step_no").collect()]
    assert funnel == [5, 4, 4, 3, 2, 1]


def test_supermarket_csv(spark, tmp_dir):
    path = os.path.join(tmp_dir, "shops.csv")
    with open(path, "w") as f:
        f.write("OBJECTID,Name,Suburb,Town - City,Territorial Authority,Shape__Area,Shape__Length\n")
        f.write("1,Shop A,Mt Eden,Auckland,Auckland,1.5,2.5\n2,Shop B,Frankton,Hamilton,Hamilton,1.0,1.0\n")
    schema = T.StructType([T.StructField(c, t) for c, t in [
        ("OBJECTID", T.LongType()), ("Name", T.StringType()), ("Suburb", T.StringType()),
        ("Town - City", T.StringType()), ("Territorial Authority", T.StringType()),
        ("Shape__Area", T.DoubleType()), ("Shape__Length", T.DoubleType())]])
    out = ingest_supermarket_file(read_delimited(spark, path, schema))
    assert out.columns == ["OBJECTID", "NAME", "SUBURB", "TOWN_CITY", "TERRITORIAL AUTHORITY", "SHAPE_AREA",
                           "SHAPE_LENGTH"]
    assert [r.OBJECTID for r in out.collect()] == [1]


def test_json_envelopes(spark, tmp_dir):
    stops = os.path.join(tmp_dir, "stops.json")
    with open(stops, "w") as f:
        json.dump({"data": [{"id": "1", "attributes": {"stop_id": "s1", "stop_lat": -36.8, "stop_lon": 174.7}},
                            {"id": "2", "attributes": {"stop_id": "s2", "stop_lat": -36.9, "stop_lon": 174.8}}]}, f)
    schools = os.path.join(tmp_dir, "schools.json")
    with open(schools, "w") as f:
        json.dump({"result": {"records": [{"School_Id": 1, "Org_Name": "A"}, {"School_Id": 2, "Org_Name": "B"}]}}, f)
    s = read_json_records(spark, stops, "data", inner="attributes")
    assert sorted(r.stop_id for r in s.collect()) == ["s1", "s2"]
    r = read_json_records(spark, schools, "result.records")
    assert sorted(x.Org_Name for x in r.collect()) == ["A", "B"]


def test_calendar_grid(spark):
    bounds = spark.createDataFrame([(2018, 2026)], "start_year int, end_year int")
    g = calendar_grid(bounds)
    assert g.count() == 9 * 12
    first = g.orderBy("month_start").first()
    assert (first.year, first.month, first.report_date, first.path) == (2018, "january", "2018-01-01 00:00:00",
                                                                        "2018/january")
    back = g.select(month_start(F.col("year"), F.col("month")).alias("d"), "month_start")
    assert back.filter(F.col("d") != F.col("month_start")).count() == 0


def test_window_heading_carry_equals_tokeniser(spark):
    pages = spark.createDataFrame([(1, REPORT_HTML), (2, "<p>x</p><h3>A</h3><p>y</p><h3></h3><table><tr><td>z</td></tr></table>")],
                                  "page_id long, html string")
    el = H.page_elements(pages, ["page_id"])
    win = H.with_current_heading(el, "page_id")
    a = sorted((r.page_id, r.pos, r.heading) for r in el.collect())
    b = sorted((r.page_id, r.pos, r.heading) for r in win.collect())
    assert a == b


def test_unclosed_paragraphs_close_implicitly(spark):
    html = "<h1>T</h1><p><b>lede &amp more<br><p>next</p><div>x</div><p>tail</article>"
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    got = [r.text for r in H.heading_blocks(pages, "page_id", "h1", "p").orderBy("block_pos").collect()]
    assert got == ["lede & more", "next", "tail"]


def test_price_pages_to_landing(spark):
    from tussock.sources.ingest import ingest_price_pages
    from tussock.plans.staging import stg_prices
    bounds = spark.createDataFrame([(2025, 2025)], "start_year int, end_year int")
    cal = calendar_grid(bounds)
    pages = spark.createDataFrame([
        ("https://x.example/market-reports/2025/march/suburb-report", 200, REPORT_HTML),
        ("https://x.example/market-reports/2025/april/suburb-report", 404, REPORT_HTML),
        ("https://x.example/market-reports/2025/may/suburb-report", 200, "<p>no tables</p>"),
    ], "url string, status int, html string")
    path = F.regexp_extract("url", r"(\d{4}/[a-z]+)/suburb-report", 1)
    landed = ingest_price_pages(pages, cal, path)
    got = sorted((r.year, r.month, r.report_date, r.district, r.suburb) for r in landed.collect())
    assert got == [(2025, "march", "2025-03-01 00:00:00", "North Shore", "Albany"),
                   (2025, "march", "2025-03-01 00:00:00", "North Shore", "Milford"),
                   (2025, "march", "2025-03-01 00:00:00", "West", "Swanson")]
    flags = sorted(r.data_quality_flag for r in stg_prices(landed).collect())
    assert flags == ["missing_price", "ok", "ok"]


def test_text_envelope_result_records(spark):
    from tussock.sources.payloads import envelope_schema, flatten_envelope
    record = T.StructType([T.StructField("School_Id", T.LongType()), T.StructField("Org_Name", T.StringType())])
    df = spark.createDataFrame([(1, '{"result":{"records":[{"School_Id":7,"Org_Name":"A"},{"School_Id":8,"Org_Name":"B"}]}}'),
                                (2, '{"result":{"records":[]}}')], "batch int, payload string")
    out = flatten_envelope(df, "payload", envelope_schema(record, "records", outer="result"), "result.records",
                           keep=["batch"])
    assert sorted((r.batch, r.School_Id, r.Org_Name) for r in out.collect()) == [(1, 7, "A"), (1, 8, "B")]


def test_rate_sheet_with_day_first_dates(spark):
    row = ["31/01/2001", "6.5"] + ["0"] * 5 + ["6.1", "0", "5.9"] + ["0"] * 7 + ["6.3"]
    raw = spark.createDataFrame([row, ["Series"] + ["x"] * 17], ", ".join(f"_c{i} string" for i in range(18)))
    got = [tuple(r) for r in rates_from_positions(raw, "dd/MM/yyyy").collect()]
    assert got == [(dt.date(2001, 1, 31), 6.5, 6.1, 5.9, 6.3)]


def test_json_lines_envelopes(spark, tmp_dir):
    path = os.path.join(tmp_dir, "pages.jsonl")
    with open(path, "w") as f:
        for batch in range(3):
            f.write(json.dumps({"data": [{"attributes": {"stop_id": f"s{batch}{i}"}} for i in range(2)]}) + "\n")
    rows = read_json_records(spark, path, "data", inner="attributes", multiline=False)
    assert sorted(r.stop_id for r in rows.collect()) == ["s00", "s01", "s10", "s11", "s20", "s21"]


def test_census_name_probe_default_list(spark):
    from tussock.sources.ingest import census_name_probe
    rows = [("Median household income", "Statistical area 2", "Otara East", 2023, "Median", "1"),
            ("Median household income", "Statistical area 2", "Te Atatu South-McLeod", 2023, "Median", "1"),
            ("Median household income", "Statistical area 2", "Mangere Bridge", 2018, "Median", "1")]
    raw = spark.createDataFrame(rows, "section_title string, classification_label string, descriptor string, "
                                      "period int, value_type_description string, value string")
    got = {(r.keyword, r.match) for r in census_name_probe(raw).collect()}
    assert ("Otara", "Otara East") in got and ("Te Atatu South", "Te Atatu South-McLeod") in got
    assert ("Mangere Bridge", "NOT FOUND") in got and ("Ranui", "NOT FOUND") in got
    assert len(got) == 9


def test_nested_tables_give_all_descendant_rows():
    """Hand-worked: rows and cells of nested tables belong to the outer table too."""
    from tussock.sources.html import tokenise
    page = ("<h3>A</h3><table><tr><td>h</td></tr><tr><td>r1</td><td>x<table><tr><td>n0</td></tr><tr><td>n1</td><td>n2</td></tr></table>y</td></tr>"
            "<tr><td>r2</table><h3>B</h3><table><tr><td>z</table><p>tail")
    rows = [(heading, table, row, cells) for _, heading, kind, table, row, _, cells in tokenise(page, "h3", None) if kind == "row"]
    assert rows == [
        ("A", 0, 0, ["h"]), ("A", 0, 1, ["r1", "xn0n1n2y", "n0", "n1", "n2"]), ("A", 0, 2, ["n0"]), ("A", 0, 3, ["n1", "n2"]), ("A", 0, 4, ["r2"]),
        ("A", 1, 0, ["n0"]), ("A", 1, 1, ["n1", "n2"]),
        ("B", 2, 0, ["z"])]
