"""Landing sources: schemas, named-source registry and file readers.

Landing schemas are explicit ``StructType`` values; nothing is inferred.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, D, L, I, TS = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.TimestampType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


LANDING_SCHEMAS: dict[str, T.StructType] = {
    "interest_rates": _schema(("date", S), ("ocr_rate", D), ("bank_bill_90d", D), ("govt_bond_2yr", D),
                              ("swap_rate_2yr", D), ("ingested_at", TS)),
    "census": _schema(("section_title", S), ("classification_label", S), ("descriptor", S), ("period", I),
                      ("value_type_description", S), ("value", D), ("value_label", S), ("ingested_at", TS)),
    "suburb_prices": _schema(("year", I), ("month", S), ("report_date", S), ("district", S), ("suburb", S),
                             ("avg_sale_price", D), ("avg_weekly_rent", D), ("gross_yield_pct", D),
                             ("ingested_at", TS)),
    "transit_stops": _schema(("stop_id", S), ("stop_code", S), ("stop_name", S), ("stop_lat", S),
                             ("stop_lon", S), ("location_type", I), ("parent_station", S), ("ingested_at", TS)),
    "supermarkets": _schema(("objectid", L), ("name", S), ("suburb", S), ("town_city", S),
                            ("territorial_authority", S), ("shape_area", D), ("shape_length", D),
                            ("ingested_at", TS)),
    "schools": _schema(("school_id", L), ("org_name", S), ("org_type", S), ("authority", S), ("coed_status", S),
                       ("add1_suburb", S), ("add1_city", S), ("territorial_authority", S),
                       ("regional_council", S), ("statistical_area_2_code", S),
                       ("statistical_area_2_description", S), ("latitude", S), ("longitude", S),
                       ("eqi_index", S), ("total", S), ("status", S), ("dateschoolopened", S),
                       ("ingested_at", TS)),
}

# --- Fixed values (column layout of the census export file: 22 columns, header row replaced) ---
CENSUS_FILE_COLUMNS = [
    "section_title", "section_type", "classification_label", "code", "descriptor", "period", "duration",
    "variable1_label", "variable1_code", "variable1_descriptor", "variable2_label", "variable2_code",
    "variable2_descriptor", "value_type_description", "value", "value_label", "decimals",
    "confidentiality_indicator", "confidentiality_label", "final_indicator", "final_label",
    "last_updated_at_source",
]
# --- end of fixed values ---


# Schemas of the given tables (column names and types of their files).
TABLE_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "pages": "page_id long, url string, html string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Given table ``<sf_dir>/<name>.parquet``; its schema is known, so no footer is read to plan."""
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(os.path.join(sf_dir, f"{name}.parquet"))


def conform(df: DataFrame, schema: T.StructType, required: list[str] | None = None) -> DataFrame:
    """Project onto a landing schema: cast present columns, add absent ones as typed NULLs.

    ``required`` names columns that must be there; a missing one raises ``KeyError``.
    """
    present = {c.lower(): c for c in df.columns}
    absent = [c for c in required or () if c not in present]
    if absent:
        raise KeyError(f"columns not found in the source: {absent}")
    cols = []
    for f in schema.fields:
        if f.name in present:
            cols.append(F.col(f"`{present[f.name]}`").cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


class SourceRegistry:
    """Named landing sources: name -> (path, schema). ``source(name)`` reads one."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root, fmt

    def path(self, name: str) -> str:
        return os.path.join(self.root, name)

    def source(self, name: str) -> DataFrame:
        schema = LANDING_SCHEMAS[name]
        return self.spark.read.schema(schema).format(self.fmt).load(self.path(name))


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    """Delimited scan with an explicit schema; ``header=True`` skips (replaces) the file header."""
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def read_census_file(spark: SparkSession, path: str, keep: list[str] | None = None) -> DataFrame:
    """22-column census export with its own header replaced by known names; the
    kept subset is a projection Catalyst prunes at the scan."""
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in CENSUS_FILE_COLUMNS])
    df = read_delimited(spark, path, schema, header=True)
    return df.select(*(keep or CENSUS_FILE_COLUMNS))


def read_headerless(spark: SparkSession, path: str, n_cols: int) -> DataFrame:
    """Headerless spreadsheet export as text columns ``_c0 .. _c{n-1}``.

    Preamble rows are not dropped by position (that would need an ordered,
    single-reader scan); callers drop them by content, e.g. rows whose first
    column does not parse as a date.
    """
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType(), True) for i in range(n_cols)])
    return spark.read.schema(schema).option("header", False).csv(path)


def preamble_dictionary(spark: SparkSession, path: str, n_rows: int = 5) -> DataFrame:
    """Column dictionary from the first lines of a headerless file:
    (column index, first-line label, second-line label).

    Only the first ``n_rows`` lines are read (a limit on one file keeps file
    order), so the per-column lists are bounded by ``n_rows``.
    """
    lines = spark.read.text(path).limit(n_rows).withColumn("line_no", F.monotonically_increasing_id())
    # Quoted cells keep their commas: split outside quotes only, then drop the quotes.
    parts = F.split(F.col("value"), r',(?=(?:[^"]*"[^"]*")*[^"]*$)')
    cells = lines.select("line_no", F.posexplode(
        F.transform(parts, lambda c: F.replace(F.regexp_replace(c, r'^"(.*)"$', "$1"), F.lit('""'), F.lit('"')))).alias("col_idx", "cell"))
    per_col = cells.groupBy("col_idx").agg(F.sort_array(F.collect_list(F.struct("line_no", "cell"))).alias("c"))
    return per_col.select(
        "col_idx",
        F.col("c")[0]["cell"].alias("label_0"),
        F.try_element_at(F.col("c"), F.lit(2))["cell"].alias("label_1"),
    ).orderBy("col_idx")


def read_json_records(spark: SparkSession, path: str, array_path: str, schema: T.StructType | None = None,
                      inner: str | None = None, multiline: bool = True) -> DataFrame:
    """JSON API payload -> one row per record.

    ``array_path`` is the dotted path of the record array (``data`` or
    ``result.records``); ``inner`` the member holding the fields
    (``attributes``) if records are wrapped. A multi-line JSON file cannot be
    split, so each file is one task: right for API responses (one envelope per
    file, many files in parallel). Bulk exports should be JSON Lines, one
    envelope per line (``multiline=False``), which splits like any text file.
    """
    reader = spark.read.option("multiLine", multiline)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.json(path)
    rec = df.select(F.explode(F.col(array_path)).alias("r"))
    return rec.select(f"r.{inner}.*" if inner else "r.*")


def read_json_members(spark: SparkSession, path: str, array_path: str, members: list[str], inner: str | None = None,
                      multiline: bool = True) -> DataFrame:
    """Records of a JSON API payload as the text columns ``members``; nothing is inferred.

    Numbers keep their spelling, nested values their JSON text. A member that some
    records lack is null there; one that no record has raises ``KeyError`` (a
    payload without records gives no rows). Other members are not kept. See
    ``read_json_records`` for ``multiline``.
    """
    texts = T.MapType(S, S)
    node: T.DataType = T.ArrayType(T.StructType([T.StructField(inner, texts)]) if inner else texts)
    for name in reversed(array_path.split(".")):
        node = T.StructType([T.StructField(name, node)])
    payload = spark.read.schema(node).option("multiLine", multiline).json(path)
    record = payload.select(F.explode(F.col(array_path)).alias("r")).select((F.col(f"r.{inner}") if inner else F.col("r")).alias("r"))
    held = record.agg(*(F.bool_or(F.map_contains_key("r", F.lit(m))).alias(f"m{i}") for i, m in enumerate(members))).first()
    absent = [m for m, there in zip(members, held) if there is False]
    if absent:
        raise KeyError(f"columns not found in the source: {absent}")
    return record.select(*(F.col("r")[m].alias(m) for m in members))
