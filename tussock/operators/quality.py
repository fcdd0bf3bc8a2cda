"""Data-quality checks, coverage and profiles as DataFrames (never printed)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tussock.operators.textmatch import contains_matches

NOT_FOUND = "NOT FOUND"


def not_null_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """One pass: (column_name, failing_rows, passed) for each not-null contract."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in columns)
    long = wide.selectExpr(f"stack({len(columns)}, {stack}) as (column_name, failing_rows)")
    return long.withColumn("passed", F.col("failing_rows") == 0)


def nan_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """One pass: (column_name, nan_rows, passed). NaN must not reach averages
    (one NaN turns a Spark mean into NaN); coercions turn it into NULL."""
    wide = df.agg(*[F.count_if(F.isnan(F.col(c))).alias(c) for c in columns])
    stack = ", ".join(f"'{c}', `{c}`" for c in columns)
    long = wide.selectExpr(f"stack({len(columns)}, {stack}) as (column_name, nan_rows)")
    return long.withColumn("passed", F.col("nan_rows") == 0)


def null_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    """The failing rows themselves (any listed column NULL)."""
    cond = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    return df.filter(cond)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys appearing more than once, with their row counts; zero rows = pass."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
            .filter(F.col("row_count") > 1))


#: Bit of the keys themselves in a coverage table; the sources have the next ones, in order.
KEY_BIT = 1


def coverage_bits(keys: DataFrame, key_col: str, sources: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(suburb_key, bits) for each distinct key: bit 0 for the keys, one bit for each source that has it.

    All sides are stacked and folded with ``bit_or``: one shuffle by key however many sources there are, with
    partial folding before it. Sources may have keys of their own, which are dropped.
    """
    both = keys.select(F.col(key_col).alias("suburb_key"), F.lit(KEY_BIT).alias("bits"))
    for i, (dim, col) in enumerate(sources.values()):
        both = both.unionByName(dim.select(F.col(col).alias("suburb_key"), F.lit(KEY_BIT << (i + 1)).alias("bits")))
    folded = both.filter(F.col("suburb_key").isNotNull()).groupBy("suburb_key").agg(F.bit_or("bits").alias("bits"))
    return folded.filter(F.col("bits").bitwiseAND(KEY_BIT) != 0)


def _covered(i: int) -> Column:
    return F.col("bits").bitwiseAND(KEY_BIT << (i + 1)) != 0


def unmatched_keys(keys: DataFrame, key_col: str, sources: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(source, key) for each distinct key with no match in the source."""
    missing = F.array_compact(F.array(*(F.when(~_covered(i), F.lit(name)) for i, name in enumerate(sources))))
    return coverage_bits(keys, key_col, sources).select(F.explode(missing).alias("source"), "suburb_key")


def match_rates(keys: DataFrame, key_col: str, sources: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(source, n_keys, n_matched, n_unmatched, match_rate) per source, from one pass over the coverage table."""
    wide = coverage_bits(keys, key_col, sources).agg(
        F.count(F.lit(1)).alias("n_keys"), *(F.count_if(_covered(i)).alias(f"n{i}") for i in range(len(sources))))
    rows = F.explode(F.array(*(F.struct(F.lit(name).alias("source"), F.col(f"n{i}").alias("n_matched")) for i, name in enumerate(sources))))
    out = wide.select("n_keys", rows.alias("r")).select("r.source", "n_keys", "r.n_matched")
    return out.select(
        "source", "n_keys", "n_matched",
        (F.col("n_keys") - F.col("n_matched")).alias("n_unmatched"),
        F.round(F.col("n_matched") / F.nullif(F.col("n_keys"), F.lit(0)), 4).alias("match_rate"),
    )


def keyword_probe(texts: DataFrame, text_col: str, keywords: DataFrame, kw_col: str) -> DataFrame:
    """For each keyword, the distinct texts containing it (case-insensitive), or
    one 'NOT FOUND' row when none does."""
    kw = keywords.select(F.col(kw_col).alias("keyword")).filter(F.col("keyword").isNotNull()).distinct()
    distinct_texts = texts.select(F.col(text_col).alias("match")).filter(F.col("match").isNotNull()).distinct()
    hits = contains_matches(distinct_texts, "match", kw, "keyword")
    return (kw.join(hits, "keyword", "left")
            .select("keyword", F.coalesce(F.col("match"), F.lit(NOT_FOUND)).alias("match")))


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count, column_count) for each frame."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count"))
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def distinct_profile(df: DataFrame, key_col: str, date_col: str, label_format: str = "MMM yyyy",
                     approx: bool = False) -> DataFrame:
    """Rows, distinct keys, first/last date and the latest-month label, one pass.
    ``approx=True`` uses a HyperLogLog sketch for the distinct count (profiling
    very large tables without a shuffle of the distinct values)."""
    distinct = F.approx_count_distinct(key_col) if approx else F.countDistinct(key_col)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        distinct.alias("n_distinct"),
        F.min(date_col).alias("first_date"),
        F.max(date_col).alias("last_date"),
    ).withColumn("latest_label", F.date_format("last_date", label_format))


def split_rejects(df: DataFrame, checks: dict[str, "F.Column"]) -> tuple[DataFrame, DataFrame]:
    """Coerce-or-reject: ``checks`` maps a reason to a predicate that must hold.

    Returns (accepted rows, rejected rows with the FIRST failing reason in
    ``reject_reason``). One pass; predicates evaluating to NULL count as failed.
    """
    reason = None
    for name, ok in checks.items():
        failed = ~F.coalesce(ok, F.lit(False))
        reason = F.when(failed, F.lit(name)) if reason is None else reason.when(failed, F.lit(name))
    tagged = df.withColumn("reject_reason", reason)
    return (tagged.filter(F.col("reject_reason").isNull()).drop("reject_reason"),
            tagged.filter(F.col("reject_reason").isNotNull()))
