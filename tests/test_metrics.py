import math

from pyspark.sql import functions as F

from tussock.functions.cleaning import null_nan, try_int
from tussock.functions.metrics import affordability_index, price_to_income_ratio, quality_flag
from tussock.functions.scores import amenity_score, liveability_score, school_score, transit_score
from tussock.plans.staging import stop_type


def _col(spark, values, fn, typ):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {typ}")
    got = {r.i: r.y for r in df.select("i", fn(F.col("x")).alias("y")).collect()}
    return [got[i] for i in range(len(values))]


def test_quality_flag(spark):
    vals = [None, float("nan"), 199999.99, 200000.0, 5000000.0, 5000000.01]
    got = _col(spark, vals, lambda c: quality_flag(null_nan(c)), "double")
    assert got == ["missing_price", "missing_price", "suspect_low", "ok", "ok", "suspect_high"]


def test_nan_never_flags_high(spark):
    # NaN > 5e6 is true in Spark; the flag treats NaN as missing, and the
    # range predicate used by the mart rejects it.
    from tussock.functions.metrics import price_is_ok
    assert _col(spark, [float("nan")], lambda c: quality_flag(c), "double") == ["missing_price"]
    assert _col(spark, [float("nan")], lambda c: quality_flag(null_nan(c)), "double") == ["missing_price"]
    assert _col(spark, [float("nan"), 300000.0], price_is_ok, "double") == [False, True]


def test_stop_type(spark):
    assert _col(spark, [0, 1, 2, 3, None], stop_type, "int") == ["stop", "station", "entrance", "other", "other"]


def test_school_score(spark):
    got = _col(spark, [300.0, 344.0, 456.5, 569.0, 700.0, None], school_score, "double")
    assert got == [0.0, 0.0, 5.0, 10.0, 10.0, None]


def test_amenity_and_transit_scores(spark):
    assert _col(spark, [1, 5, 9], amenity_score, "long") == [2.0, 10.0, 10.0]
    assert _col(spark, [0, 15, 30, 50], transit_score, "long") == [0.0, 5.0, 10.0, 10.0]
    assert _col(spark, [1], transit_score, "long") == [0.333333]


def test_liveability(spark):
    df = spark.createDataFrame([(5.0, 5.0, 5.0), (None, 10.0, None), (10.0, None, 10.0), (None, None, None)],
                               "t double, s double, a double")
    got = [r.l for r in df.select(liveability_score("t", "s", "a").alias("l")).collect()]
    assert got == [5.0, 4.0, 6.0, 0.0]


def test_affordability(spark):
    rows = [(1000000.0, 100000.0, 5.0), (1000000.0, 100000.0, None), (1000000.0, 0.0, 5.0),
            (1000000.0, None, 5.0), (1000000.0, 30000.0, 5.0)]
    df = spark.createDataFrame(rows, "p double, i double, s double")
    got = [(r.r, r.x) for r in df.select(price_to_income_ratio("p", "i").alias("r"),
                                         affordability_index("p", "i", "s").alias("x")).collect()]
    assert got == [(10.0, 10.5), (10.0, None), (None, None), (None, None), (33.33, 35.0)]


def test_try_int_accepts_integral_text(spark):
    assert _col(spark, ["12.0", "12", "12.5", "x", None, "1e20"], try_int, "string") == [12, 12, 13, None, None, None]
