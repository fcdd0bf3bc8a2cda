"""End-to-end batch run: landing -> staging -> marts (stored) -> checks -> reports.

This is the Spark form of "build the models, then test them":

* the school staging frame feeds both marts, so it is computed once and its
  lineage cut with ``checkpoint()`` into the shared folder named by
  ``spark.checkpoint.dir`` (a lost executor then re-reads it instead of
  recomputing the chain);
* marts are written as parquet tables (the affordability mart partitioned by
  year so time-window reports can prune files), then read back;
* data-quality checks and reports run against the stored mart.

Disabled models are skipped by flag, as in a model config.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tussock.operators.quality import duplicate_keys, nan_report, not_null_report
from tussock.plans import marts, reports
from tussock.plans import staging as stg
from tussock.session import checkpoint_dir

NOT_NULL_COLUMNS = ["report_date", "suburb", "avg_sale_price"]
UNIQUE_KEY = ["suburb", "report_date"]
# Files that a year of the stored mart is spread over, at most.
FILES_A_YEAR = 8
PRICE_MEASURES = ["avg_sale_price", "avg_weekly_rent", "gross_yield_pct"]


@dataclass
class RunResult:
    paths: dict[str, str] = field(default_factory=dict)
    checks: dict[str, DataFrame] = field(default_factory=dict)


def build(spark: SparkSession, landing: stg.Landing, out_root: str,
          enabled: dict[str, bool] | None = None) -> RunResult:
    enabled = {"affordability": True, "liveability": True, **(enabled or {})}
    checkpoint_dir(spark)
    res = RunResult()
    schools_stg = stg.stg_schools(landing.schools).checkpoint(eager=True)

    res.checks["nan_prices"] = nan_report(stg.stg_prices(landing.prices), PRICE_MEASURES)
    if enabled["affordability"]:
        path = os.path.join(out_root, "mart_affordability_index")
        aff = marts.affordability_mart(landing, schools_stg)
        # Rows of a year meet in a few tasks (spread by suburb), so a year has few files.
        (aff.withColumn("report_year", F.year("report_date"))
         .repartition("report_year", F.pmod(F.xxhash64("suburb"), F.lit(FILES_A_YEAR)))
         .write.mode("overwrite").partitionBy("report_year").parquet(path))
        res.paths["affordability"] = path
        stored = read_affordability(spark, path)
        res.checks["not_null"] = not_null_report(stored, NOT_NULL_COLUMNS)
        res.checks["unique"] = duplicate_keys(stored, UNIQUE_KEY)

    if enabled["liveability"]:
        path = os.path.join(out_root, "mart_liveability_scores")
        marts.liveability_mart(landing, schools_stg).write.mode("overwrite").parquet(path)
        res.paths["liveability"] = path
    return res


def read_affordability(spark: SparkSession, path: str, keep_partition: bool = False,
                       cache: bool = False) -> DataFrame:
    """Stored mart with lower-case names; the ``report_year`` partition column
    is dropped unless ``keep_partition`` (reports use it to prune files).
    ``cache=True`` keeps it in executor memory for a session serving many
    reports (a lost block is re-read from the parquet files)."""
    df = spark.read.parquet(path)
    if not keep_partition:
        df = df.drop("report_year")
    df = df.toDF(*[c.lower() for c in df.columns])
    return df.cache() if cache else df


def dashboard(mart: DataFrame, selection: list[str] | None = None) -> dict[str, DataFrame]:
    """All report frames for one stored mart."""
    spark = mart.sparkSession
    wanted = spark.createDataFrame([(s,) for s in (selection or reports.DEFAULT_SUBURBS)], "suburb string")
    part = "report_year" if "report_year" in mart.columns else None
    cycle = reports.rate_cycle(mart)
    return {
        "header": reports.latest_label(mart),
        "index_over_time": reports.index_over_time(mart, wanted),
        "price_to_income_3m": reports.price_to_income_recent(mart, year_partition=part),
        "rate_cycle": cycle,
        "top_schools": reports.top_schools(mart, year_partition=part),
        "top_amenity": reports.top_amenity(mart, year_partition=part),
        "yield_3m": reports.yield_recent(mart, year_partition=part),
        "peak_to_trough": reports.peak_to_trough(cycle),
    }


def land_testdata(spark: SparkSession, sf_dir: str, landing_root: str) -> dict[str, int]:
    """Write the test-data landing frames as landing tables (explicit schemas,
    audit column, full replace). Returns rows written per source."""
    from tussock.sources.landing import LANDING_SCHEMAS, conform
    from tussock.sources.sinks import write_landing

    names = {"prices": "suburb_prices", "rates": "interest_rates", "census": "census", "schools": "schools",
             "supermarkets": "supermarkets", "stops": "transit_stops"}
    landing = stg.Landing.from_testdata(spark, sf_dir)
    counts = {}
    for attr, table in names.items():
        frame = conform(getattr(landing, attr), LANDING_SCHEMAS[table]).drop("ingested_at")
        counts[table] = write_landing(frame, os.path.join(landing_root, table))
    return counts


def write_reports(mart: DataFrame, out_root: str, selection: list[str] | None = None) -> dict[str, str]:
    """Materialise every report frame as a small serving table."""
    paths = {}
    for name, frame in dashboard(mart, selection).items():
        path = os.path.join(out_root, f"report_{name}")
        frame.write.mode("overwrite").parquet(path)
        paths[name] = path
    return paths
