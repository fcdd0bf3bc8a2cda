"""Sinks: full replace, append, views, tables, and the text export form.

A full replace that reads its own target first stages to a sibling path, so
the source files are never deleted while still being read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tussock.functions.cleaning import datetimes_as_text, fold_columns, with_audit


def write_landing(df: DataFrame, path: str, overwrite: bool = True, audit: bool = True,
                  upper_case: bool = False, partition_by: list[str] | None = None) -> int:
    """Land a frame as parquet (overwrite = replace the table, else append) and
    return the number of rows written, observed during the write."""
    out = with_audit(df) if audit else df
    written = Observation()
    out = out.observe(written, F.count(F.lit(1)).alias("rows"))
    out = fold_columns(out, upper=True) if upper_case else out
    w = out.write.mode("overwrite" if overwrite else "append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return written.get["rows"]


def replace_in_place(spark: SparkSession, df: DataFrame, path: str, staging_path: str) -> DataFrame:
    """Overwrite a table whose new content is derived from itself: write to a
    staging path, then replace the target from the staged copy."""
    df.write.mode("overwrite").parquet(staging_path)
    spark.read.parquet(staging_path).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def export_text_datetimes(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Export with every datetime rendered as 'yyyy-MM-dd HH:mm:ss' text."""
    datetimes_as_text(df).write.mode("overwrite").option("header", True).format(fmt).save(path)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """View materialisation: a named, lazily evaluated plan."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def as_table(df: DataFrame, name: str, partition_by: list[str] | None = None, enabled: bool = True) -> DataFrame | None:
    """Table materialisation (``saveAsTable``); ``enabled=False`` skips the model."""
    if not enabled:
        return None
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    return df.sparkSession.table(name)
