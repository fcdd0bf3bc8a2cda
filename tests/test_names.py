import pytest
from pyspark.sql import functions as F

from tussock.functions.names import canonical_supermarket_suburb, parent_suburb, suburb_key

PARENT_CASES = [
    ("Mount Eden North", "mount eden"),
    ("Mount Eden North West (Auckland)", "mount eden"),
    ("Ponsonby East", "ponsonby"),
    ("x central-north", "x"),
    ("a central north east", "a central"),
    ("north", "north"),
    ("mount eden north ", "mount eden north"),
    ("Northcote", "northcote"),
    (None, None),
]

KEY_CASES = [(" Mt Albert ", "mount albert"), ("Mount Albert", "mount albert"), ("Belmt X", "belmount x"), ("Mt", "mt")]

ALIAS_CASES = [("MT ROSKILL", "mount roskill"), ("Oteha ", "albany"), ("Te Atatu", "te atatu peninsula"),
               ("The Gardens", "flat bush"), ("Murrays Bay", "murrays bay"), ("Elsewhere", "elsewhere")]


def _apply(spark, cases, fn):
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(cases)], "i int, x string")
    got = {r.i: r.y for r in df.select("i", fn(F.col("x")).alias("y")).collect()}
    return [got[i] for i in range(len(cases))]


def test_parent_suburb(spark):
    assert _apply(spark, PARENT_CASES, parent_suburb) == [e for _, e in PARENT_CASES]


def test_parent_suburb_is_single_pass(spark):
    once = _apply(spark, [("a north south", None)], parent_suburb)[0]
    assert once == "a north"  # a second pass would strip again


def test_suburb_key(spark):
    assert _apply(spark, KEY_CASES, suburb_key) == [e for _, e in KEY_CASES]


def test_alias_map(spark):
    assert _apply(spark, ALIAS_CASES, canonical_supermarket_suburb) == [e for _, e in ALIAS_CASES]


def test_supermarket_staging_drops_null_suburb(spark):
    from tussock.plans.staging import stg_supermarkets
    df = spark.createDataFrame([(1, " A ", "Mt Eden"), (2, "B", None)], "objectid long, name string, suburb string")
    rows = stg_supermarkets(df).collect()
    assert [(r.supermarket_id, r.supermarket_name, r.suburb) for r in rows] == [(1, "a", "mount eden")]
