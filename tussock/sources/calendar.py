"""Monthly request calendar and month-name handling, as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values (English month names, lower case, calendar order) ---
MONTH_NAMES = [
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]
# --- end of fixed values ---


def month_number(name: Column) -> Column:
    """'march' -> 3 (0 when not a month name)."""
    return F.array_position(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.lower(name)).cast("int")


def month_start(year: Column, name: Column) -> Column:
    """(year, month name) -> first day of that month."""
    return F.make_date(year, month_number(name), F.lit(1))


def month_name(d: Column) -> Column:
    """Date -> lower-case English month name."""
    return F.element_at(F.array(*[F.lit(m) for m in MONTH_NAMES]), F.month(d))


def calendar_grid(bounds: DataFrame, start_year_col: str = "start_year", end_year_col: str = "end_year") -> DataFrame:
    """Every month of every year from start to end year (inclusive), one row per
    month: year, month name, month number, first-of-month date and report text.

    ``bounds`` holds one row per range (usually one); months are generated with
    ``sequence`` + ``explode`` on executors, not in a driver loop.
    """
    start = F.make_date(F.col(start_year_col), F.lit(1), F.lit(1))
    end = F.make_date(F.col(end_year_col), F.lit(12), F.lit(1))
    months = bounds.select(F.explode(F.sequence(start, end, F.expr("INTERVAL 1 MONTH"))).alias("month_start"))
    return months.select(
        F.year("month_start").alias("year"),
        month_name(F.col("month_start")).alias("month"),
        F.month("month_start").alias("month_no"),
        "month_start",
        F.concat(F.date_format("month_start", "yyyy-MM-dd"), F.lit(" 00:00:00")).alias("report_date"),
        F.concat_ws("/", F.year("month_start").cast("string"), month_name(F.col("month_start"))).alias("path"),
    )
