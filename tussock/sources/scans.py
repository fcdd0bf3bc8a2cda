"""Scans of delimited files that keep what doesn't parse, with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def scan_delimited(spark: SparkSession, path: str, schema: T.StructType, header: bool = True, delimiter: str = ",") -> DataFrame:
    """Rows of delimited files with ``schema``, and the whole line in ``_corrupt_record`` where one doesn't fit it
    (too few or too many fields, or a value that isn't of its type); such a line's other columns hold what could be read."""
    with_line = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])
    return (spark.read.schema(with_line).option("header", header).option("enforceSchema", True).option("sep", delimiter).option("escape", '"')
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).csv(path))


def _fields(line: Column, delimiter: str) -> Column:
    """Number of fields of a line, quotes respected."""
    bare = F.regexp_replace(line, '"([^"]|"")*"', "q")
    return F.length(bare) - F.length(F.replace(bare, F.lit(delimiter), F.lit(""))) + 1


def good_lines(scan: DataFrame) -> DataFrame:
    """The rows that fit their schema."""
    return scan.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def bad_lines(scan: DataFrame, n_fields: int, delimiter: str = ",") -> DataFrame:
    """(line, reason, n_read) of the others: ``short_line``, ``long_line`` or ``bad_value``, and the number of its
    fields that could be read."""
    fields = _fields(F.col(CORRUPT), delimiter)
    reason = F.when(fields < n_fields, "short_line").when(fields > n_fields, "long_line").otherwise("bad_value")
    read = sum((F.col(f"`{c}`").isNotNull().cast("int") for c in scan.columns if c != CORRUPT), F.lit(0))
    return scan.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("line"), reason.alias("reason"), read.alias("n_read"))


def scan_columns(spark: SparkSession, path: str, schema: T.StructType, keep: list[str], header: bool = True, delimiter: str = ",") -> DataFrame:
    """The ``keep`` columns alone, cut out while the lines are parsed. Lines are taken as they are: which of them
    are malformed is not looked at (use ``scan_delimited`` for that)."""
    return (spark.read.schema(schema).option("header", header).option("enforceSchema", True).option("sep", delimiter)
            .csv(path).select(*keep))
