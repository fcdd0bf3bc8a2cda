"""Mergeable mart state, batches that can be repeated, stored marts, file scans, frequent values, distinct sketches, carry-forward."""

import datetime as dt
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tussock.operators import frequent
from tussock.operators.quality import coverage_bits, match_rates, unmatched_keys
from tussock.operators.textmatch import contains_matches, mark_contains, with_grams
from tussock.operators.windows import carry_forward, forward_fill
from tussock.plans import marts, upkeep
from tussock.plans.catalog import QUERIES
from tussock.plans.reports import peak_to_trough
from tussock.sources import batches, scans

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ------------------------------------------------------------- keywords ---

def test_keywords_match_whatever_their_length(spark):
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("abAB é𝒳") for _ in range(rnd.randint(0, 150))) for _ in range(150)] + ["", "Mount 12 x", "mount 1"]
    kws = ["a", "AB", "é𝒳", "aba", "abab", "mount 1", "mount 12", "Mount 3", "", "𝒳", "b a", "ababab"]
    tdf = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(900, None), (901, texts[0])], "i long, t string")
    kdf = spark.createDataFrame([(k,) for k in kws] + [(None,), ("AB",)], "k string")
    got = Counter((r.i, r.k) for r in contains_matches(tdf, "t", kdf, "k").collect())
    want = Counter((i, k) for i, t in list(enumerate(texts)) + [(901, texts[0])] for k in set(kws) if k and k.lower() in t.lower())
    assert got == want and len(want) > 200
    marked = {r.i: r.hit for r in mark_contains(tdf, "t", kdf, "k", "hit").collect()}
    assert marked[900] is False and sum(marked.values()) == len({i for i, _ in want})


@pytest.mark.parametrize("n", [5_000, 80_000, 1_000_000])
def test_grams_are_linear_in_the_text(spark, n):
    text = "".join(chr(97 + i * i % 7) for i in range(n))
    df = spark.createDataFrame([(text,)], "t string")
    got = {r._gram for r in with_grams(df, "t", (6,)).collect()}
    assert got == {text[i:i + 6] for i in range(n - 5)}


def test_a_keyword_meets_a_text_on_its_rarest_gram(spark):
    """All keywords share a beginning: no text is joined with a keyword whose own part it doesn't hold."""
    texts = spark.range(400).select(F.concat(F.lit("mount view "), F.col("id").cast("string")).alias("t"))
    kws = spark.createDataFrame([(f"mount view {i}",) for i in range(100, 130)], "k string")
    assert {(r.t, r.k) for r in contains_matches(texts, "t", kws, "k").collect()} == {(f"mount view {i}", f"mount view {i}") for i in range(100, 130)}


# ------------------------------------------------------------- coverage ---

def test_coverage_from_one_table(spark):
    keys = spark.createDataFrame([("a",), ("b",), ("c",), ("c",), (None,)], "k string")
    x = spark.createDataFrame([("a",), ("z",), ("a",), (None,)], "n string")
    none = spark.createDataFrame([], "n string")
    sources = {"x": (x, "n"), "none": (none, "n")}
    assert {(r.suburb_key, r.bits) for r in coverage_bits(keys, "k", sources).collect()} == {("a", 3), ("b", 1), ("c", 1)}
    assert sorted(map(tuple, unmatched_keys(keys, "k", sources).collect())) == sorted(
        [("x", "b"), ("x", "c"), ("none", "a"), ("none", "b"), ("none", "c")])
    assert sorted(map(tuple, match_rates(keys, "k", sources).collect())) == [("none", 3, 0, 3, 0.0), ("x", 3, 1, 2, 0.3333)]
    assert plan(unmatched_keys(keys, "k", sources)).split("Initial Plan")[0].count("Exchange hashpartitioning") == 1


# -------------------------------------------------------- peak to trough ---

def brute_peak(points):
    points = sorted((d, v) for d, v in points if d is not None and v is not None)
    if not points:
        return []
    peak = min(points, key=lambda p: (-p[1], p[0]))
    after = [p for p in points if p[0] > peak[0]]
    low = min(after, key=lambda p: (p[1], p[0]), default=(None, None))
    return [(*peak, *low)]


def test_peak_to_trough_of_any_series(spark):
    rnd = random.Random(4)
    series = [[], [(dt.date(2020, 1, 1), 5.0)], [(None, 4.0), (dt.date(2020, 1, 1), None)]]
    for n in (2, 5, 40, 200):
        for _ in range(4):
            days = rnd.sample(range(3000), n)
            series.append([(dt.date(2015, 1, 1) + dt.timedelta(d), float(rnd.randint(1, 6 if n < 40 else 90))) for d in days])
    for points in series:
        df = spark.createDataFrame(points, "report_date date, avg_sale_price double")
        assert [tuple(r)[:4] for r in peak_to_trough(df).collect()] == brute_peak(points)


def test_report_evaluates_the_mart_once(spark):
    once, whole = (plan(QUERIES[q](spark, SF)).split("Initial Plan")[0].count("FileScan") for q in ("affordability_mart", "report_peak_to_trough"))
    assert whole <= once


# ------------------------------------------------------------ mart state ---

def test_merged_states_equal_a_rebuild(spark):
    rnd = random.Random(2)
    rows = [(f"s{rnd.randint(0, 5)}", "d", dt.date(2020, rnd.randint(1, 4), rnd.randint(1, 28)), rnd.choice([None, 300000.5, 250000.0, 400000.25, 1.0]),
             rnd.choice([None, 400.5, 401.0]), rnd.choice([None, 4.125, 5.0])) for _ in range(400)]
    df = spark.createDataFrame(rows, "suburb string, district string, report_date date, avg_sale_price double, avg_weekly_rent double, gross_yield_pct double")
    df = df.withColumn("report_month", F.trunc("report_date", "month")).withColumn("data_quality_flag", F.lit("ok")).withColumn("n", F.monotonically_increasing_id())
    want = sorted(map(str, marts.property_by_suburb_month(df.drop("n")).collect()))
    cut = [df.filter(F.col("n") % 3 == i).drop("n") for i in range(3)]
    states = [upkeep.price_state(c) for c in cut]
    columns = marts.property_by_suburb_month(df).columns
    one = upkeep.merged_state(upkeep.merged_state(states[0], states[1]), states[2])
    other = upkeep.merged_state(states[2], states[0], states[1])
    for state in (one, other):
        assert sorted(map(str, upkeep.property_of_state(state).select(*columns).collect())) == want
    assert upkeep.property_of_state(upkeep.price_state(df.limit(0))).count() == 0


# --------------------------------------------------------------- batches ---

def frame(spark, lo, hi):
    return spark.range(lo, hi).select("id", F.lit("x").alias("v"))


def test_repeated_batch_counts_once_and_unfinished_ones_not(spark, tmp_dir):
    root = f"file://{tmp_dir}/landing"
    for _ in range(3):
        batches.land_batch(frame(spark, 0, 100), root, "a")
    batches.land_batch(frame(spark, 100, 150), root, "007")
    batches.write_batch(frame(spark, 500, 600), root, "half", attempt="1")
    got = batches.read_batches(spark, root)
    assert sorted((r.batch_id, r.id) for r in got.collect()) == sorted([("a", i) for i in range(100)] + [("007", i) for i in range(100, 150)])
    assert sorted(map(tuple, batches.manifest(spark, root).select("batch_id", "attempt", "row_count").collect())) == [("007", "1", 50), ("a", "1", 100)]
    # A second attempt that broke off before its commit: the rows it replaced don't count, nor do its own, until the commit.
    batches.write_batch(frame(spark, 0, 30), root, "a", attempt="2")
    assert batches.read_batches(spark, root).filter("batch_id = 'a'").count() == 0
    batches.commit_batch(spark, root, "a", "2")
    assert batches.read_batches(spark, root).filter("batch_id = 'a'").count() == 30
    batches.land_batch(frame(spark, 0, 0), root, "empty")
    assert batches.read_batches(spark, root).count() == 80


# ----------------------------------------------------------- stored mart ---

def test_stored_mart_is_pruned_and_joined_in_place(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["stored_mart_below_peak"](spark, SF)
        text = plan(df).split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "PartitionFilters: [isnotnull(report_year" in text and ">= 1998" in text
    assert "SortMergeJoin" in text and "Exchange" not in text and "SelectedBucketsCount" in text
    assert df.count() > 0 and df.agg(F.min("report_date")).first()[0].year >= 1998


# ------------------------------------------------------------ file scans ---

def test_malformed_lines_come_out_with_a_reason(spark, tmp_dir):
    path = os.path.join(tmp_dir, "in.csv")
    lines = ["id,x,name", '1,2.5,"a, b"', "2,3", "3,4,c,d", "x,1,e", '4,5,"say ""hi, you"""', "5,,", "6,7.5,z"]
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    schema = T.StructType.fromDDL("id long, x double, name string")
    scan = scans.scan_delimited(spark, f"file://{path}", schema)
    assert sorted(r.id for r in scans.good_lines(scan).collect()) == [1, 4, 5, 6]
    bad = {r.line: (r.reason, r.n_read) for r in scans.bad_lines(scan, 3).collect()}
    assert bad == {"2,3": ("short_line", 2), "3,4,c,d": ("long_line", 3), "x,1,e": ("bad_value", 2)}
    pruned = scans.scan_columns(spark, f"file://{path}", schema, ["x"])
    assert "ReadSchema: struct<x:double>" in plan(pruned) and pruned.count() == 7


# ------------------------------------------------- frequent and distinct ---

@pytest.mark.parametrize("k,tracked", [(3, 10_000), (3, 16), (50, 16), (500, 10_000)])
def test_most_frequent_is_exact_with_ties(spark, k, tracked):
    rnd = random.Random(k)
    values = [f"v{min(int(rnd.expovariate(0.3)), 40)}" for _ in range(3000)] + [f"rare{i}" for i in range(300)] + [None] * 50
    counts = Counter(v for v in values if v is not None)
    last = sorted(counts.values(), reverse=True)[:k][-1]
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(4)
    assert {(r.value, r.row_count) for r in frequent.most_frequent(df, "v", k, tracked).collect()} == {(v, c) for v, c in counts.items() if c >= last}
    assert frequent.most_frequent(df.limit(0), "v", k, tracked).count() == 0


def test_distinct_sketches_merge_within_their_bound(spark):
    df = spark.range(60_000).select((F.col("id") % 5 + 2000).cast("int").alias("y"), F.pmod(F.xxhash64("id"), F.lit(9000)).alias("v"))
    exact = {r.period: r.n_distinct for r in frequent.distinct_exactly(df, "v", F.col("y"), 3).collect()}
    rows = df.select("y", "v").distinct().collect()
    assert exact == {y: len({r.v for r in rows if y - 2 <= r.y <= y}) for y in range(2000, 2005)}
    for r in frequent.distinct_over(frequent.distinct_state(df, "v", F.col("y")), 3).collect():
        assert abs(r.estimate - exact[r.period]) <= 4 * frequent.DISTINCT_ERROR * exact[r.period]


# ---------------------------------------------------------- carry forward ---

def test_carry_forward_equals_the_window(spark):
    rnd = random.Random(6)
    rows = [(rnd.choice(["hot", "hot", "a", "b", None]), i, rnd.choice([None, None, None, float(i)])) for i in rnd.sample(range(5000), 2500)]
    df = spark.createDataFrame(rows, "s string, pos long, v double")
    want = sorted(map(str, forward_fill(df, "v", "s", "pos", "f").collect()))
    for width in (7, 100, 10_000):
        got = carry_forward(df, "v", "s", "pos", "f", F.floor(F.col("pos") / width))
        assert sorted(map(str, got.collect())) == want
