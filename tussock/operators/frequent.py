"""Most frequent values and distinct counts from mergeable sketches, with exact results beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Values a frequency sketch keeps track of; its size does not depend on the data.
TRACKED = 10_000
# A sketch's count is off by at most this part of all rows, over the number of values tracked.
SKETCH_ERROR = 3.5
# Registers of a distinct sketch (2 ** LG_K) and its relative standard error, 1.04 / sqrt(2 ** LG_K).
LG_K = 14
DISTINCT_ERROR = 1.04 / 2 ** (LG_K / 2)


def most_frequent(df: DataFrame, col: str, k: int, tracked: int = TRACKED) -> DataFrame:
    """(value, row_count) of the ``k`` most frequent non-null values, exactly, with all ties of the last one.

    A mergeable frequency sketch gives candidates: a value's count in it is off by at most ``error`` (3.5 rows in
    ``tracked``), and one that it doesn't hold occurs at most ``error`` times. What may be among the k is counted exactly,
    after a semi join with the candidates (``tracked`` at most, so they are broadcast), and no other value is shuffled.
    Only where counts are too even for the sketch to tell (the k-th may lie below twice ``error``) is every value counted.
    """
    rows = df.select(F.col(col).alias("value")).filter(F.col("value").isNotNull())
    sketch = rows.agg(F.expr(f"approx_top_k(value, {tracked}, {tracked})").alias("top"), F.count(F.lit(1)).alias("n"))
    error = F.lit(SKETCH_ERROR) * F.col("n") / F.lit(tracked)
    kth = F.col("top")[k - 1]["count"] - error
    sketch = sketch.select("top", error.alias("error"), F.when(F.size("top") >= k, kth).alias("least"))
    # Fewer tracked values than k: all values are candidates if none can be missing, which the sketch can't tell.
    even = sketch.select(F.coalesce(F.col("least") <= 2 * F.col("error"), F.lit(True))).scalar()
    candidates = sketch.select(F.explode("top").alias("c"), "error", "least").filter(F.col("c.count") >= F.coalesce("least", F.lit(0.0)))
    candidates = F.broadcast(candidates.select(F.col("c.item").alias("value")))
    counted = rows.join(candidates, "value", "left_semi").unionByName(rows.filter(even).join(candidates, "value", "left_anti"))
    counts = counted.groupBy("value").agg(F.count(F.lit(1)).alias("row_count"))
    # The k-th count, from the top k rows alone.
    last = counts.select("row_count").orderBy(F.desc("row_count")).limit(k).agg(F.min("row_count")).scalar()
    return counts.filter(F.col("row_count") >= last)


def distinct_state(df: DataFrame, col: str, by: F.Column, name: str = "period") -> DataFrame:
    """(period, sketch): a mergeable distinct sketch of ``col`` for each period, of a fixed size, to be stored."""
    return df.groupBy(by.alias(name)).agg(F.hll_sketch_agg(col, LG_K).alias("sketch"))


def distinct_over(state: DataFrame, periods: int, name: str = "period") -> DataFrame:
    """(period, estimate): distinct values of the ``periods`` periods that end with each, by merging their sketches.

    Every stored sketch goes to the periods it counts for, and is merged there; no value is read again.
    """
    ends = state.select(F.explode(F.sequence(F.col(name), F.col(name) + periods - 1)).alias("_end"), "sketch")
    merged = ends.groupBy("_end").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
    return merged.join(state.select(F.col(name).alias("_end")), "_end").select(F.col("_end").alias(name), "estimate")


def distinct_exactly(df: DataFrame, col: str, by: F.Column, periods: int, name: str = "period") -> DataFrame:
    """(period, n_distinct) over the same windows, exactly: each (period, value) once, then each value once a window."""
    pairs = df.select(by.alias(name), F.col(col).alias("_v")).filter(F.col("_v").isNotNull()).distinct()
    there = pairs.select(F.col(name).alias("_end")).distinct()
    ends = pairs.select(F.explode(F.sequence(F.col(name), F.col(name) + periods - 1)).alias("_end"), "_v")
    counts = ends.distinct().groupBy("_end").agg(F.count(F.lit(1)).alias("n_distinct"))
    return counts.join(there, "_end").select(F.col("_end").alias(name), "n_distinct")
