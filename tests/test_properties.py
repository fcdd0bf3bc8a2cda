"""Property tests (hypothesis): each example is evaluated in one Spark job and
compared with a plain-Python model of the rule."""

import datetime as dt
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tussock.functions.names import PARENT_NAME_SUFFIXES, parent_suburb, suburb_key
from tussock.functions.scores import clamp_scale
from tussock.sources.ingest import patch_union

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))

WORDS = ["mount", "eden", "north", "south", "west", "east", "central", "mt", "ponsonby", "hill", "park",
         "heights", "valley", "red", "hills", "(auckland)", "(city)", "-", "north-west", "Mt", "MOUNT"]
names = st.lists(st.sampled_from(WORDS), min_size=0, max_size=6).map(" ".join) | st.text(
    alphabet="abcmt ()-NSEW", max_size=20)


def _model_parent(s):
    if s is None:
        return None
    x = re.sub(r"\s*\([^)]*\)$", "", s.lower())
    x = re.sub(r"\s+(" + "|".join(PARENT_NAME_SUFFIXES) + r")$", "", x, count=1)
    return x.strip(" ")


def _eval(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {typ}")
    got = {r.i: r.y for r in df.select("i", fn(F.col("x")).alias("y")).collect()}
    return [got[i] for i in range(len(values))]


@SETTINGS
@given(st.lists(names, min_size=1, max_size=30))
def test_parent_suburb_matches_model(spark, values):
    assert _eval(spark, values, parent_suburb) == [_model_parent(v) for v in values]


@SETTINGS
@given(st.lists(names, min_size=1, max_size=30))
def test_suburb_key_matches_model(spark, values):
    assert _eval(spark, values, suburb_key) == [v.strip(" ").lower().replace("mt ", "mount ") for v in values]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.floats(min_value=-1e6, max_value=1e6)), min_size=1, max_size=40))
def test_clamp_scale_bounded(spark, values):
    got = _eval(spark, values, lambda c: clamp_scale(c, 344, 22.5, 10), "double")
    for v, g in zip(values, got):
        if v is None:
            assert g is None
        else:
            assert 0.0 <= g <= 10.0
            assert abs(g - min(max(v - 344, 0) / 22.5, 10)) < 1e-9


dates = st.dates(min_value=dt.date(2015, 1, 1), max_value=dt.date(2030, 12, 31))


@SETTINGS
@given(st.lists(dates, min_size=0, max_size=20, unique=True), st.lists(dates, min_size=1, max_size=8, unique=True))
def test_patch_union_invariants(spark, base, patch):
    schema = "date date, v int"
    b = spark.createDataFrame([(d, 0) for d in base], schema)
    p = spark.createDataFrame([(d, 1) for d in patch], schema)
    rows = [(r.date, r.v) for r in patch_union(b, p).collect()]
    cut = min(patch)
    assert sorted(rows) == sorted([(d, 0) for d in base if d < cut] + [(d, 1) for d in patch])


short_text = st.text(alphabet="abAB c-", min_size=0, max_size=12)


@SETTINGS
@given(st.lists(st.one_of(st.none(), short_text), min_size=1, max_size=25),
       st.lists(st.text(alphabet="abAB c-", min_size=1, max_size=9), min_size=1, max_size=6))
def test_contains_matches_model(spark, texts, keywords):
    from tussock.operators.textmatch import contains_matches, semi_join_contains
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    kw = spark.createDataFrame([(k,) for k in keywords], "k string")
    want_pairs = {(i, k) for i, t in enumerate(texts) if t is not None for k in set(keywords)
                  if k.lower() in t.lower()}
    want_ids = sorted({i for i, _ in want_pairs})
    pairs = {(r.id, r.k) for r in contains_matches(df, "t", kw, "k").collect()}
    ids = sorted(r.id for r in semi_join_contains(df, "t", kw, "k").collect())
    assert pairs == want_pairs and ids == want_ids


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from("abc"), st.one_of(st.none(), st.integers(0, 3)),
                          st.integers(0, 3)), min_size=1, max_size=30))
def test_keep_greatest_matches_window_form(spark, rows):
    from tussock.operators.windows import keep_first, keep_greatest
    df = spark.createDataFrame(rows, "k string, m int, n int")
    agg = sorted(tuple(r) for r in keep_greatest(df, "k", ["m", "n"]).collect())
    win = sorted(tuple(r) for r in keep_first(df, "k", [F.desc_nulls_last("m"), F.desc_nulls_last("n")]).collect())
    assert agg == win
