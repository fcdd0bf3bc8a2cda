"""JSON API payloads held as text: parse, explode records, project fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def envelope_schema(record: T.StructType, array_field: str = "data", outer: str | None = None) -> T.StructType:
    """``{"data": [record...]}`` or, with ``outer='result'`` and
    ``array_field='records'``, ``{"result": {"records": [record...]}}``."""
    arr = T.StructType([T.StructField(array_field, T.ArrayType(record), True)])
    return T.StructType([T.StructField(outer, arr, True)]) if outer else arr


def flatten_envelope(df: DataFrame, payload_col: str, schema: T.StructType, array_path: str,
                     fields: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """Parse ``payload_col`` with an explicit schema, explode the record array at
    ``array_path``, and project the record's ``fields`` struct (or the record
    itself) to columns. ``keep`` columns of the input are carried along."""
    keep = keep or []
    parsed = df.select(*keep, F.from_json(F.col(payload_col), schema).alias("_p"))
    rec = parsed.select(*keep, F.explode(F.col(f"_p.{array_path}")).alias("_r"))
    return rec.select(*keep, f"_r.{fields}.*" if fields else "_r.*")
