import os

from conftest import SF_SMALL

from tussock.plans import marts, pipeline
from tussock.plans.staging import Landing


def test_pipeline_writes_marts_and_checks_pass(spark, tmp_dir):
    landing = Landing.from_testdata(spark, SF_SMALL)
    res = pipeline.build(spark, landing, tmp_dir)
    stored = pipeline.read_affordability(spark, res.paths["affordability"])
    direct = marts.affordability_mart(landing)
    assert stored.count() == direct.count() > 0
    assert sorted(stored.columns) == sorted(direct.columns)
    assert res.checks["unique"].count() == 0
    assert all(r.passed for r in res.checks["not_null"].collect())
    assert os.path.isdir(os.path.join(res.paths["affordability"]))
    assert spark.read.parquet(res.paths["liveability"]).count() > 0
    frames = pipeline.dashboard(stored, ["Mt 1", "Nowhere"])
    assert frames["header"].first().n_suburbs > 0
    assert frames["index_over_time"].select("suburb").distinct().count() == 1


def test_disabled_model_is_skipped(spark, tmp_dir):
    res = pipeline.build(spark, Landing.from_testdata(spark, SF_SMALL), tmp_dir, enabled={"liveability": False})
    assert "liveability" not in res.paths


def test_stored_mart_reports_prune_year_partitions(spark, tmp_dir):
    res = pipeline.build(spark, Landing.from_testdata(spark, SF_SMALL), tmp_dir, enabled={"liveability": False})
    with_part = pipeline.read_affordability(spark, res.paths["affordability"], keep_partition=True)
    plain = pipeline.read_affordability(spark, res.paths["affordability"])
    a = pipeline.dashboard(with_part)
    b = pipeline.dashboard(plain)
    for name in ("price_to_income_3m", "top_schools", "top_amenity", "yield_3m"):
        assert sorted(map(tuple, a[name].collect())) == sorted(map(tuple, b[name].collect())), name
    plan = a["yield_3m"]._jdf.queryExecution().executedPlan().toString()
    assert "report_year" in plan and "PartitionFilters: [isnotnull(report_year" in plan


def test_cli_land_build_report_matches_direct_mart(spark, tmp_dir):
    from tussock.__main__ import main
    landing_root, out = os.path.join(tmp_dir, "landing"), os.path.join(tmp_dir, "marts")
    counts = main(["land", "--sf", SF_SMALL, "--landing", landing_root], spark=spark)
    assert counts["suburb_prices"] > 0 and counts["census"] > 0
    built = main(["build", "--landing", landing_root, "--out", out], spark=spark)
    assert built["failing"] == {"unique": 0, "not_null": 0, "nan": 0}
    stored = pipeline.read_affordability(spark, built["paths"]["affordability"])
    direct = marts.affordability_mart(Landing.from_testdata(spark, SF_SMALL))
    assert sorted(map(tuple, stored.select(*direct.columns).collect()), key=str) == \
        sorted(map(tuple, direct.collect()), key=str)
    reports = main(["report", "--out", out, "--suburb", "Mt 1"], spark=spark)
    assert spark.read.parquet(reports["index_over_time"]).count() > 0


def test_price_filter_and_pruning_reach_the_landing_scan(spark, tmp_dir):
    from tussock.sources.landing import SourceRegistry
    pipeline.land_testdata(spark, SF_SMALL, tmp_dir)
    mart = marts.affordability_mart(Landing.from_registry(SourceRegistry(spark, tmp_dir)))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        plan = mart._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "suburb_prices" in line)
    assert "GreaterThanOrEqual(avg_sale_price,200000.0)" in scan
    assert "LessThanOrEqual(avg_sale_price,5000000.0)" in scan
    read_schema = scan[scan.index("ReadSchema"):]
    assert "district" not in read_schema and "ingested_at" not in read_schema
