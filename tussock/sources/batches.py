"""Landing in batches that can be repeated: a batch counts once, a half-written one not at all."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = "batch_id"
MANIFEST = "batch_id string, attempt string, row_count long"


def _data(root: str) -> str:
    return f"{root}/data"


def _manifest(root: str) -> str:
    return f"{root}/manifest"


def write_batch(df: DataFrame, root: str, batch_id: str, attempt: str) -> None:
    """Write the rows of a batch; readers don't see them before ``commit_batch``.

    A batch is a partition of the table and replaces only itself (dynamic partition overwrite), so a repeated
    batch leaves the others as they are. Rows carry the attempt that wrote them.
    """
    rows = df.withColumns({"attempt": F.lit(attempt), BATCH: F.lit(batch_id)})
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(_data(root))


def commit_batch(spark: SparkSession, root: str, batch_id: str, attempt: str) -> None:
    """Make the batch's rows of ``attempt`` count, with their number as found in the files.

    The manifest holds one row a batch, in the batch's own partition, replaced in one job: a repeated commit changes nothing.
    """
    rows = spark.read.parquet(_data(root)).filter((F.col(BATCH) == batch_id) & (F.col("attempt") == attempt))
    entry = rows.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(attempt).alias("attempt"), "row_count", F.lit(batch_id).alias(BATCH))
    entry.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(_manifest(root))


def land_batch(df: DataFrame, root: str, batch_id: str, attempt: str = "1") -> None:
    """Write a batch and commit it. Safe to repeat after any failure, with the same or another attempt."""
    write_batch(df, root, batch_id, attempt)
    commit_batch(df.sparkSession, root, batch_id, attempt)


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """Committed batches: (batch_id, attempt, row_count)."""
    return spark.read.schema(MANIFEST).parquet(_manifest(root))


def read_batches(spark: SparkSession, root: str) -> DataFrame:
    """Rows of the committed attempts, with ``batch_id``. A batch whose rows of that attempt were since replaced by an
    attempt not yet committed reads as nothing until the commit."""
    done = manifest(spark, root).select(F.col(BATCH).alias("_batch"), F.col("attempt").alias("_attempt"))
    rows = spark.read.parquet(_data(root)).withColumn(BATCH, F.col(BATCH).cast("string"))
    return rows.join(done, (F.col(BATCH) == F.col("_batch")) & (F.col("attempt") == F.col("_attempt")), "left_semi").drop("attempt")
