import datetime as dt

from pyspark.sql import functions as F

from tussock.operators.quality import duplicate_keys, keyword_probe, not_null_report
from tussock.operators.textmatch import contains_matches, mark_contains, semi_join_contains
from tussock.operators.windows import keep_first, keep_greatest, latest_window, top_k


def test_latest_window(spark):
    rows = [(dt.date(2025, 12, 1),), (dt.date(2026, 1, 1),), (dt.date(2026, 2, 1),), (dt.date(2026, 3, 1),), (None,)]
    df = spark.createDataFrame(rows, "d date")
    got = sorted(str(r.d) for r in latest_window(df, "d", 3).collect())
    assert got == ["2026-01-01", "2026-02-01", "2026-03-01"]


def test_keep_first_top_k_ties(spark):
    df = spark.createDataFrame([("b", 5.0, 1), ("a", 5.0, 2), ("c", 4.0, 1), ("a", 3.0, 9)],
                               "suburb string, m double, n int")
    first = keep_first(df, "suburb", [F.desc("m")])
    got = [(r.suburb, r.m) for r in top_k(first, "m", 2, "suburb").collect()]
    assert got == [("a", 5.0), ("b", 5.0)]


def test_unique_and_not_null(spark):
    df = spark.createDataFrame([("x", dt.date(2020, 1, 1), 1.0), ("x", dt.date(2020, 1, 1), None)],
                               "suburb string, report_date date, avg_sale_price double")
    d = duplicate_keys(df, ["suburb", "report_date"]).collect()
    assert [(r.suburb, r.row_count) for r in d] == [("x", 2)]
    nn = {r.column_name: (r.failing_rows, r.passed) for r in not_null_report(df, ["suburb", "avg_sale_price"]).collect()}
    assert nn == {"suburb": (0, True), "avg_sale_price": (1, False)}


def _texts(spark):
    return spark.createDataFrame([(1, "Mount 33 North"), (2, "Epsom"), (3, None), (4, "mount 3")],
                                 "id int, descriptor string")


def test_contains_forms(spark):
    texts = _texts(spark)
    kw = spark.createDataFrame([("Mount 3",), ("EPSOM",), ("zzz",)], "keyword string")
    pairs = contains_matches(texts, "descriptor", kw, "keyword")
    assert pairs.columns == ["id", "descriptor", "keyword"]
    assert {(r.id, r.keyword) for r in pairs.collect()} == {(1, "Mount 3"), (2, "EPSOM"), (4, "Mount 3")}
    semi = semi_join_contains(texts, "descriptor", kw, "keyword")
    assert semi.columns == ["id", "descriptor"] and sorted(r.id for r in semi.collect()) == [1, 2, 4]
    assert mark_contains(texts, "descriptor", kw, "keyword", "f").columns == ["id", "descriptor", "f"]
    none = contains_matches(texts, "descriptor", kw.limit(0), "keyword")
    assert none.collect() == [] and semi_join_contains(texts, "descriptor", kw.limit(0), "keyword").collect() == []
    flags = {r.id: r.f for r in mark_contains(texts, "descriptor", kw, "keyword", "f").collect()}
    assert flags == {1: True, 2: True, 3: False, 4: True}


def test_keyword_probe_not_found(spark):
    kw = spark.createDataFrame([("mount 3",), ("nowhere",)], "k string")
    got = sorted((r.keyword, r.match) for r in keyword_probe(_texts(spark), "descriptor", kw, "k").collect())
    assert got == [("mount 3", "Mount 33 North"), ("mount 3", "mount 3"), ("nowhere", "NOT FOUND")]


def test_suburb_choices_sorted_distinct(spark):
    from tussock.plans.reports import suburb_choices
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "suburb string")
    assert [r.suburb for r in suburb_choices(df).collect()] == ["a", "b"]


def test_keep_greatest_equals_keep_first(spark):
    rows = [("a", 5.0, 1), ("a", 5.0, 3), ("a", 4.0, 9), ("b", None, 1), ("b", 2.0, 0), ("c", 1.0, None)]
    df = spark.createDataFrame(rows, "suburb string, m double, n int")
    agg = sorted(tuple(r) for r in keep_greatest(df, "suburb", ["m", "n"]).collect())
    win = sorted(tuple(r) for r in keep_first(df, "suburb", [F.desc_nulls_last("m"), F.desc_nulls_last("n")]).collect())
    assert agg == win == [("a", 5.0, 3), ("b", 2.0, 0), ("c", 1.0, None)]


def test_nan_report(spark):
    from tussock.operators.quality import nan_report
    df = spark.createDataFrame([(1.0, float("nan")), (None, 2.0)], "a double, b double")
    got = {r.column_name: (r.nan_rows, r.passed) for r in nan_report(df, ["a", "b"]).collect()}
    assert got == {"a": (0, True), "b": (1, False)}


def test_select_positions_and_approx_profile(spark):
    from tussock.functions.cleaning import select_positions
    from tussock.operators.quality import distinct_profile
    df = spark.createDataFrame([(1, "a", 2.0, "x")], "c0 int, c1 string, c2 double, c3 string")
    assert select_positions(df, [0, 2], ["id", "v"]).collect()[0].asDict() == {"id": 1, "v": 2.0}
    rows = spark.createDataFrame([(f"s{i % 7}", dt.date(2020, 1 + i % 12, 1)) for i in range(100)],
                                 "suburb string, report_date date")
    exact = distinct_profile(rows, "suburb", "report_date").first()
    approx = distinct_profile(rows, "suburb", "report_date", approx=True).first()
    assert exact.n_distinct == approx.n_distinct == 7 and exact.latest_label == "Dec 2020"
