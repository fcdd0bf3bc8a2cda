"""Raw files -> ingest jobs (command line) -> landing tables -> marts."""

import json
import os

import pytest
from test_sources import REPORT_HTML

from tussock.__main__ import main
from tussock.plans import pipeline
from tussock.sources import jobs
from tussock.sources.landing import CENSUS_FILE_COLUMNS


def _census_line(title, level, descriptor, period, vtype, value):
    cells = dict.fromkeys(CENSUS_FILE_COLUMNS, "")
    cells.update(section_title=title, classification_label=level, descriptor=descriptor, period=str(period),
                 value_type_description=vtype, value=value, value_label="Dollars")
    return ",".join(cells[c] for c in CENSUS_FILE_COLUMNS)


def _write_raw(spark, d):
    rates = os.path.join(d, "rates.csv")
    with open(rates, "w") as f:
        f.write(",".join(["Series"] + [f"h{i}" for i in range(1, 18)]) + "\n")
        f.write(",".join(["31/03/2025", "3.5"] + ["0"] * 5 + ["3.6", "0", "3.7"] + ["0"] * 7 + ["4.0"]) + "\n")
    census = os.path.join(d, "census.csv")
    with open(census, "w") as f:
        f.write("header" + ",x" * 21 + "\n")
        f.write(_census_line("Median household income", "Statistical area 2", "Albany Central", 2023, "Median",
                             "100000") + "\n")
        f.write(_census_line("Median household income", "Statistical area 2", "Milford", 2023, "Median",
                             "90000") + "\n")
    shops = os.path.join(d, "shops.csv")
    with open(shops, "w") as f:
        f.write("OBJECTID,Name,Suburb,Town - City,Territorial Authority,Shape__Area,Shape__Length\n")
        f.write("1,Shop A,Oteha,Auckland,Auckland,1.5,2.5\n2,Shop B,Frankton,Hamilton,Hamilton,1.0,1.0\n")
    stops = os.path.join(d, "stops.json")
    with open(stops, "w") as f:
        json.dump({"data": [{"id": "1", "attributes": {"stop_id": "s1", "stop_code": "1", "stop_name": "A",
                                                       "stop_lat": -36.8, "stop_lon": 174.7,
                                                       "location_type": 0, "parent_station": None}}]}, f)
    schools = os.path.join(d, "schools.json")
    rec = {c: None for c in ["School_Id", "Org_Name", "Org_Type", "Authority", "CoEd_Status", "Add1_Suburb",
                             "Add1_City", "Territorial_Authority", "Regional_Council", "Statistical_Area_2_Code",
                             "Statistical_Area_2_Description", "Latitude", "Longitude", "EQi_Index", "Total",
                             "Status", "DateSchoolOpened", "Extra"]}
    rec.update(School_Id=1, Org_Name="Albany School", Add1_Suburb=" Albany ", Latitude="-36.73",
               Longitude="174.70", EQi_Index="400", Total="120.0", Status="Open")
    with open(schools, "w") as f:
        json.dump({"result": {"records": [rec]}}, f)
    pages = os.path.join(d, "pages")
    spark.createDataFrame([("https://x.example/market-reports/2025/march/suburb-report", 200, REPORT_HTML)],
                          "url string, status int, html string").write.parquet(pages)
    return {"rates": rates, "census": census, "supermarkets": shops, "stops": stops, "schools": schools,
            "prices": pages}


def test_raw_files_to_marts(spark, tmp_dir):
    files = _write_raw(spark, os.path.join(tmp_dir))
    landing = os.path.join(tmp_dir, "landing")
    counts = {}
    for source, path in files.items():
        args = ["ingest", source, "--file", path, "--landing", landing]
        if source == "rates":
            args += ["--date-format", "dd/MM/yyyy"]
        if source == "prices":
            args += ["--start-year", "2025", "--end-year", "2025"]
        counts.update(main(args, spark=spark))
    assert counts == {"rates": 9, "census": 2, "supermarkets": 1, "stops": 1, "schools": 1, "prices": 3}
    built = main(["build", "--landing", landing, "--out", os.path.join(tmp_dir, "marts")], spark=spark)
    mart = pipeline.read_affordability(spark, built["paths"]["affordability"])
    rows = {r.suburb: r for r in mart.collect()}
    assert set(rows) == {"Albany", "Swanson"}                 # Milford has no price, so no 'ok' row
    albany = rows["Albany"]
    assert (albany.median_household_income, albany.ocr_rate, albany.swap_rate_2yr) == (100000.0, 3.5, 4.0)
    assert (albany.school_count, albany.avg_eqi_index, albany.supermarket_count) == (1, 400.0, 1)
    assert albany.price_to_income_ratio == 12.34
    assert rows["Swanson"].median_household_income is None


def test_a_source_without_a_column_is_refused(spark, tmp_dir):
    files = _write_raw(spark, os.path.join(tmp_dir))
    landing = os.path.join(tmp_dir, "landing")
    assert jobs.ingest_stops_file(spark, files["stops"], landing) == 1
    for name, column in (("stops", "parent_station"), ("schools", "EQi_Index")):
        with open(files[name]) as f:
            text = f.read()
        with open(files[name], "w") as f:
            f.write(text.replace(f'"{column}"', '"other"'))
        with pytest.raises(KeyError, match=column):
            getattr(jobs, f"ingest_{name}_file")(spark, files[name], landing)
    with open(files["supermarkets"], "w") as f:
        f.write("OBJECTID,Name,Suburb,Town - City,Territorial Authority,Shape__Area\n1,Shop A,Oteha,Auckland,Auckland,1.5\n")
    with pytest.raises(KeyError, match="(?i)shape"):
        jobs.ingest_supermarkets_file(spark, files["supermarkets"], landing)
    assert spark.read.parquet(os.path.join(landing, "transit_stops")).count() == 1     # the earlier table stands


def test_payloads_by_line_and_missing_members(spark, tmp_dir):
    path, landing = os.path.join(tmp_dir, "stops.jsonl"), os.path.join(tmp_dir, "landing")
    stop = dict(stop_id="1", stop_code="0042", stop_name="A", stop_lat=-36.80, stop_lon=174.7, location_type=0, parent_station=None)
    with open(path, "w") as f:
        for i in range(3):
            later = {**stop, "stop_id": f"s{i}", "note": {"a": 1}}
            if i:
                del later["parent_station"]
            f.write(json.dumps({"data": [{"attributes": later}]}) + "\n")
        f.write(json.dumps({"data": []}) + "\n")
    assert jobs.ingest_stops_file(spark, path, landing, json_lines=True) == 3
    rows = spark.read.parquet(os.path.join(landing, "transit_stops")).orderBy("stop_id").collect()
    assert [(r.stop_id, r.stop_code, float(r.stop_lat), r.location_type, r.parent_station) for r in rows] == [
        (f"s{i}", "0042", -36.8, 0, None) for i in range(3)]
    with open(path, "w") as f:
        f.write(json.dumps({"data": []}) + "\n")
    assert jobs.ingest_stops_file(spark, path, landing, json_lines=True) == 0
