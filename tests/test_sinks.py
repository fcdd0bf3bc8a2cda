import datetime as dt
import os

from tussock.sources.sinks import as_table, as_view, export_text_datetimes, replace_in_place, write_landing


def test_overwrite_and_append(spark, tmp_dir):
    path = os.path.join(tmp_dir, "landing")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert write_landing(df, path) == 2
    assert write_landing(df, path, overwrite=False) == 2
    assert spark.read.parquet(path).count() == 4
    assert write_landing(df, path) == 2
    assert "ingested_at" in spark.read.parquet(path).columns


def test_upper_case_landing(spark, tmp_dir):
    path = os.path.join(tmp_dir, "upper")
    write_landing(spark.createDataFrame([(1,)], "id int"), path, upper_case=True)
    assert spark.read.parquet(path).columns == ["ID", "INGESTED_AT"]


def test_replace_in_place(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    spark.createDataFrame([(1,), (2,)], "id int").write.parquet(path)
    src = spark.read.parquet(path)
    out = replace_in_place(spark, src.filter("id > 1"), path, os.path.join(tmp_dir, "t_stage"))
    assert [r.id for r in out.collect()] == [2]


def test_text_export(spark, tmp_dir):
    df = spark.createDataFrame([(dt.datetime(2026, 3, 1, 4, 5, 6),)], "ts timestamp")
    out = os.path.join(tmp_dir, "csv")
    export_text_datetimes(df, out)
    assert spark.read.option("header", True).csv(out).first().ts == "2026-03-01 04:05:06"


def test_view_and_table(spark):
    df = spark.createDataFrame([(1, 2020)], "id int, y int")
    assert as_view(df, "v_test").count() == 1
    assert as_table(df, "t_test", partition_by=["y"]).count() == 1
    assert as_table(df, "t_skip", enabled=False) is None


def test_source_registry_reads_landed_tables(spark, tmp_dir):
    from tussock.sources.landing import LANDING_SCHEMAS, SourceRegistry, conform
    df = spark.createDataFrame([("2001-01-31 00:00:00", 5.5, 1.0, 2.0, 3.0)],
                               "date string, ocr_rate double, bank_bill_90d double, govt_bond_2yr double, "
                               "swap_rate_2yr double")
    write_landing(conform(df, LANDING_SCHEMAS["interest_rates"]).drop("ingested_at"),
                  os.path.join(tmp_dir, "interest_rates"))
    reg = SourceRegistry(spark, tmp_dir)
    got = reg.source("interest_rates").first()
    assert got.ocr_rate == 5.5 and got.ingested_at is not None


def test_keep_columns_fails_loudly(spark):
    import pytest

    from tussock.functions.cleaning import keep_columns
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert keep_columns(df, ["b"]).columns == ["b"]
    with pytest.raises(KeyError):
        keep_columns(df, ["a", "zzz"])


def test_rejects_and_labels(spark):
    from pyspark.sql import functions as F

    from tussock.functions.cleaning import coerce_double, money_label, month_label, number_label, try_landing_date
    from tussock.operators.quality import split_rejects
    df = spark.createDataFrame([("2001-01-31", "5.5"), ("junk", "1"), ("2001-02-28", "n/a")], "d string, v string")
    good, bad = split_rejects(df, {"bad_date": try_landing_date("d").isNotNull(),
                                   "bad_value": coerce_double("v").isNotNull()})
    assert [r.d for r in good.collect()] == ["2001-01-31"]
    assert sorted((r.d, r.reject_reason) for r in bad.collect()) == [("2001-02-28", "bad_value"), ("junk", "bad_date")]
    row = spark.range(1).select(money_label(F.lit(1234000.4)).alias("m"), number_label(F.lit(3.14159)).alias("n"),
                                month_label(F.to_date(F.lit("2026-03-01"))).alias("l")).first()
    assert (row.m, row.n, row.l) == ("$1,234,000", "3.1", "Mar 2026")


def test_cluster_conf_scales_partitions():
    from tussock.session import cluster_conf
    small = cluster_conf(10 * 2**30)
    big = cluster_conf(100 * 2**40)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert big["spark.sql.shuffle.partitions"] == "819200"
    assert big["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(128 * 2**20)
