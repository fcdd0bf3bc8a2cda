"""Dashboard report queries over the affordability mart.

Filtering, aggregation and ranking run in Spark over the mart; only the
ranked result rows leave the cluster. Means are unweighted across suburbs,
and NULL group keys are dropped explicitly (a pandas group-by drops them,
a Spark group-by keeps them). ``dates`` of a report is a frame with the mart's
latest ``report_date``, cheaper than the mart itself, so that the mart is evaluated once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tussock.operators.windows import keep_greatest, latest_snapshot, latest_window, top_k


def exact_mean(col: str, scale: int = 6) -> F.Column:
    """Mean of a measure with at most ``scale`` decimals (ratios, rates, percents),
    summed as DECIMAL: the sum is exact, so the result does not depend on the
    order in which partial sums arrive from tasks (a distributed double sum
    does, in the last bit). Digits beyond ``scale`` are rounded off first: the
    mart's measures have two. Returned as double with ``scale`` + 4 decimals. Means of
    integer-valued measures (rounded prices) are exact as doubles already."""
    return F.avg(F.col(col).cast(f"decimal(38,{scale})")).cast("double")


# --- Fixed values (dashboard defaults) ---
DEFAULT_SUBURBS = ["Ponsonby", "Remuera", "Avondale", "Manurewa"]
RECENT_MONTHS = 3
TOP_N = 30
# --- end of fixed values ---


def suburb_choices(mart: DataFrame) -> DataFrame:
    """Sorted distinct non-null suburbs (the selector's option list)."""
    return mart.select("suburb").dropna().distinct().orderBy("suburb")


def selected_suburbs(mart: DataFrame, wanted: DataFrame) -> DataFrame:
    """Requested suburbs that exist in the mart (semi join), as column ``suburb``."""
    available = mart.select("suburb").filter(F.col("suburb").isNotNull()).distinct()
    return wanted.select("suburb").distinct().join(available, "suburb", "left_semi")


def index_over_time(mart: DataFrame, wanted: DataFrame) -> DataFrame:
    """RPT-1: mean affordability index per (date, suburb) for the selected suburbs."""
    sel = selected_suburbs(mart, wanted)
    rows = mart.join(sel, "suburb", "left_semi").filter(F.col("report_date").isNotNull())
    return rows.groupBy("report_date", "suburb").agg(exact_mean("affordability_index").alias("affordability_index"))


def price_to_income_recent(mart: DataFrame, months: int = RECENT_MONTHS, year_partition: str | None = None,
                           dates: DataFrame | None = None) -> DataFrame:
    """RPT-2: latest-window mean price-to-income per suburb, NULL means dropped, ranked."""
    recent = latest_window(mart, "report_date", months, year_partition, dates).filter(F.col("suburb").isNotNull())
    agg = recent.groupBy("suburb").agg(exact_mean("price_to_income_ratio").alias("price_to_income_ratio"))
    return agg.dropna(subset=["price_to_income_ratio"]).orderBy(F.desc("price_to_income_ratio"), "suburb")


def rate_cycle(mart: DataFrame) -> DataFrame:
    """RPT-3: mean sale price and mean policy rate per date."""
    return (mart.filter(F.col("report_date").isNotNull()).groupBy("report_date")
            .agg(F.avg("avg_sale_price").alias("avg_sale_price"), exact_mean("ocr_rate").alias("ocr_rate")))


def _latest_top(mart: DataFrame, measure: str, extra: list[str], k: int, year_partition: str | None = None,
                dates: DataFrame | None = None) -> DataFrame:
    snap = latest_snapshot(mart, "report_date", year_partition, dates).select("suburb", measure, *extra)
    snap = snap.dropna(subset=[measure])
    # Keep-first per suburb as an aggregate (partial aggregation, no window).
    first = keep_greatest(snap, "suburb", [measure, *extra])
    return top_k(first, measure, k, "suburb")


def top_schools(mart: DataFrame, k: int = TOP_N, year_partition: str | None = None, dates: DataFrame | None = None) -> DataFrame:
    """RPT-4: latest snapshot, one row per suburb, top k by mean school EQI."""
    return _latest_top(mart, "avg_eqi_index", ["school_count"], k, year_partition, dates)


def top_amenity(mart: DataFrame, k: int = TOP_N, year_partition: str | None = None, dates: DataFrame | None = None) -> DataFrame:
    """RPT-5: latest snapshot, one row per suburb, top k by supermarket count."""
    return _latest_top(mart, "supermarket_count", [], k, year_partition, dates)


def yield_recent(mart: DataFrame, months: int = RECENT_MONTHS, year_partition: str | None = None,
                 dates: DataFrame | None = None) -> DataFrame:
    """RPT-6: latest-window mean yield and price per suburb, NULL yield dropped, ranked."""
    recent = latest_window(mart, "report_date", months, year_partition, dates).filter(F.col("suburb").isNotNull())
    agg = recent.groupBy("suburb").agg(
        exact_mean("gross_yield_pct").alias("gross_yield_pct"), F.avg("avg_sale_price").alias("avg_sale_price"))
    return agg.dropna(subset=["gross_yield_pct"]).orderBy(F.desc("gross_yield_pct"), "suburb")


def _summary(peak, trough, lowest) -> F.Column:
    """Summary of a range of dates: its peak, the lowest point after the peak, the lowest point at all."""
    return F.struct(peak.alias("peak"), trough.alias("trough"), lowest.alias("lowest"))


def _lower(a, b) -> F.Column:
    """The point with the lower value, ``a`` (the earlier one) on ties; nulls lose."""
    return F.when(a.isNull() | (b["value"] < a["value"]), b).otherwise(a)


def _followed(a, b) -> F.Column:
    """Summary of a range followed by another; associative, so ranges may be folded in any grouping."""
    higher = b["peak"]["value"] > a["peak"]["value"]
    return _summary(F.when(higher, b["peak"]).otherwise(a["peak"]), F.when(higher, b["trough"]).otherwise(_lower(a["trough"], b["lowest"])),
                    _lower(a["lowest"], b["lowest"]))


def _folded(summaries) -> F.Column:
    """Summary of ranges in an array of (first date, summary)."""
    ordered = F.transform(F.sort_array(summaries), lambda r: r["s"])
    return F.aggregate(F.slice(ordered, F.lit(2), F.size(ordered)), F.element_at(ordered, 1), _followed)


def peak_to_trough(series: DataFrame, date_col: str = "report_date", value_col: str = "avg_sale_price") -> DataFrame:
    """RPT-8: peak of a series (earliest date on ties), the lowest value after it
    (earliest on ties) and the change in percent. One row; none for a series without values.

    Every point is the summary of its day; the summaries of a year are folded in date order, then those of
    the years. The series is evaluated once, and a task holds a year's dates or the years.
    """
    point = F.struct(F.col(date_col).alias("date"), F.col(value_col).alias("value"))
    none = F.lit(None).cast(f"struct<date:{series.schema[date_col].dataType.simpleString()},value:{series.schema[value_col].dataType.simpleString()}>")
    days = series.filter(F.col(value_col).isNotNull() & F.col(date_col).isNotNull()).select(
        F.year(date_col).alias("y"), F.struct(F.col(date_col).alias("d"), _summary(point, none, point).alias("s")).alias("r"))
    years = days.groupBy("y").agg(F.collect_list("r").alias("rs")).select(F.struct(F.col("y").alias("d"), _folded(F.col("rs")).alias("s")).alias("r"))
    out = (years.agg(F.collect_list("r").alias("rs")).filter(F.size("rs") > 0).select(_folded(F.col("rs")).alias("s"))
           .select(F.col("s.peak.date").alias("peak_date"), F.col("s.peak.value").alias("peak_value"),
                   F.col("s.trough.date").alias("trough_date"), F.col("s.trough.value").alias("trough_value")))
    return out.withColumn(
        "change_pct", F.round((F.col("trough_value") - F.col("peak_value")) / F.col("peak_value") * 100, 2))


def latest_label(mart: DataFrame) -> DataFrame:
    """RPT-7 header facts: distinct suburbs and the latest month label."""
    return mart.agg(
        F.countDistinct("suburb").alias("n_suburbs"),
        F.date_format(F.max("report_date"), "MMM yyyy").alias("latest_month"),
    )
