"""Keeping the marts up to date: mergeable price state, and stored tables for reports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tussock.functions.metrics import price_is_ok
from tussock.session import checkpoint_dir

# Measure -> (decimals of its exact sum, decimals of its mean), as in the mart.
STATE_MEASURES = {"avg_sale_price": (6, 0), "avg_weekly_rent": (6, 0), "gross_yield_pct": (12, 2)}
STATE_KEY = ["suburb", "report_month"]
# Buckets of a stored mart: tables with the same number join by suburb without a shuffle.
BUCKETS = 8


def price_state(prices_stg: DataFrame) -> DataFrame:
    """State of a landing batch by suburb and month: exact sums and counts of each measure, latest date, least flag.

    States of any batches merge into the state of all their rows (``merged_state``), in any order and grouping, and give
    the mart's property rows (``property_of_state``). A batch may be cut in any way.
    """
    ok = prices_stg.filter(price_is_ok(F.col("avg_sale_price")))
    sums = [F.sum(F.col(m).cast(f"decimal(38,{scale})")).alias(f"{m}_sum") for m, (scale, _) in STATE_MEASURES.items()]
    counts = [F.count(m).alias(f"{m}_count") for m in STATE_MEASURES]
    return ok.groupBy(*STATE_KEY).agg(F.max("report_date").alias("report_date"), *sums, *counts,
                                      F.min("data_quality_flag").alias("data_quality_flag"))


def merged_state(*states: DataFrame) -> DataFrame:
    """One state from several: sums and counts added, latest date, least flag."""
    both = states[0]
    for s in states[1:]:
        both = both.unionByName(s)
    parts = [F.sum(f"{m}_{part}").cast(both.schema[f"{m}_{part}"].dataType).alias(f"{m}_{part}") for part in ("sum", "count") for m in STATE_MEASURES]
    return both.groupBy(*STATE_KEY).agg(F.max("report_date").alias("report_date"), *parts, F.min("data_quality_flag").alias("data_quality_flag"))


def property_of_state(state: DataFrame) -> DataFrame:
    """Property rows of the mart (``marts.property_by_suburb_month``) from a state."""
    # A sum of at most 28 digits leaves its mean ten decimals or more before the rounding.
    means = [F.round(F.try_divide(F.col(f"{m}_sum").cast(f"decimal(28,{STATE_MEASURES[m][0]})"), F.col(f"{m}_count")), decimals).cast("double").alias(m) for m, (_, decimals) in STATE_MEASURES.items()]
    return state.select(*STATE_KEY, "report_date", *means, "data_quality_flag")


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder for a run's tables, in the folder that driver and executors share."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tussock-{name}-{uuid.uuid4().hex}"


def stored_state(state: DataFrame, path: str) -> DataFrame:
    """The state written as a table and read back; a retried run replaces it."""
    state.write.mode("overwrite").parquet(path)
    return state.sparkSession.read.schema(state.schema).parquet(path)


def store_bucketed(df: DataFrame, name: str, path: str, key: str = "suburb", partition_by: list[str] | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Store ``df`` as a catalogue table bucketed and sorted by ``key``, optionally partitioned, with its files under ``path``.

    The rows of a bucket meet in one task of the write, so a bucket is one file a partition. Tables stored with the same
    key and number of buckets join on the key without moving a row.
    """
    spark = df.sparkSession
    w = df.repartition(buckets, key).write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key)
    (w.partitionBy(*partition_by) if partition_by else w).saveAsTable(name)
    return spark.table(name)


def store_mart(mart: DataFrame, root: str, tag: str) -> tuple[DataFrame, DataFrame]:
    """The affordability mart by year and suburb bucket, and each suburb's peak price in the same buckets."""
    by_year = store_bucketed(mart.withColumn("report_year", F.year("report_date")), f"mart_affordability_{tag}", f"{root}/mart",
                             partition_by=["report_year"])
    peaks = by_year.groupBy("suburb").agg(F.max("avg_sale_price").alias("peak_price"))
    return by_year, store_bucketed(peaks, f"suburb_peaks_{tag}", f"{root}/peaks")


def below_peak(mart: DataFrame, peaks: DataFrame, first_year: int) -> DataFrame:
    """Stored mart rows from ``first_year`` on (other years' files are not read) beside their suburb's peak price."""
    recent = mart.filter(F.col("report_year") >= first_year)
    return recent.join(peaks, "suburb").select("suburb", "report_date", "avg_sale_price", "peak_price")
