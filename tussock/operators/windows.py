"""Order-dependent operators expressed as scalar subqueries and windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_window(df: DataFrame, date_col: str, months: int = 3, year_partition: str | None = None,
                  dates: DataFrame | None = None) -> DataFrame:
    """Rows from the latest ``months`` months: ``date >= add_months(max(date), -(months-1))``.

    The max is a scalar subquery (one value computed once, then a plain filter),
    so the frame is neither shuffled nor collected. NULL dates never qualify.
    ``year_partition`` names a year partition column of a stored table; the
    same bound is then also applied to it so only recent partitions are read. ``dates`` is a cheaper frame with the
    same latest ``date_col`` (say the facts that ``df`` was joined from), so that ``df`` is evaluated once.
    """
    latest = (df if dates is None else dates).agg(F.max(date_col)).scalar()
    start = F.add_months(latest, -(months - 1))
    cond = F.col(date_col) >= start
    if year_partition:
        cond = (F.col(year_partition) >= F.year(start)) & cond
    return df.filter(cond)


def latest_snapshot(df: DataFrame, date_col: str, year_partition: str | None = None, dates: DataFrame | None = None) -> DataFrame:
    """Rows at the latest date: ``date = max(date)`` (optionally pruning a year partition; ``dates`` as in ``latest_window``)."""
    latest = (df if dates is None else dates).agg(F.max(date_col)).scalar()
    cond = F.col(date_col) == latest
    if year_partition:
        cond = (F.col(year_partition) == F.year(latest)) & cond
    return df.filter(cond)


def keep_first(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row per key: the first under an explicit order (deterministic, unlike
    ``dropDuplicates``)."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def keep_greatest(df: DataFrame, key: str, by: list[str]) -> DataFrame:
    """One row per key: the row with the greatest ``by`` values (compared in
    order), remaining columns breaking ties, so the pick is deterministic.

    Same result as ``keep_first`` with a descending order, but expressed as an
    aggregate (max of a struct): it aggregates partially before the shuffle,
    so a key holding a large share of the rows never lands whole in one task.
    NULL ``by`` values rank lowest.
    """
    rest = [c for c in df.columns if c != key and c not in by]
    best = F.max(F.struct(*[F.col(c) for c in by + rest])).alias("_best")
    return df.groupBy(key).agg(best).select(key, *[F.col(f"_best.{c}").alias(c) for c in df.columns if c != key])


def top_k(df: DataFrame, measure: str, k: int, tie_break: str) -> DataFrame:
    """Top-k by measure descending with a tie-break (plans as TakeOrderedAndProject)."""
    return df.orderBy(F.desc(measure), F.asc(tie_break)).limit(k)


def forward_fill(df: DataFrame, value_col: str, partition_col: str, order_col: str, out_col: str) -> DataFrame:
    """Carry the last non-null ``value_col`` forward in ``order_col`` order within a partition."""
    w = (Window.partitionBy(partition_col).orderBy(order_col)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return df.withColumn(out_col, F.last(F.col(value_col), ignorenulls=True).over(w))


def carry_forward(df: DataFrame, value_col: str, partition_col: str, order_col: str, out_col: str, chunk: Column) -> DataFrame:
    """``forward_fill`` for series too long for one task, in two levels.

    ``chunk`` cuts each series into ranges that follow each other in ``order_col`` (a year of a date, a thousand
    places of a position). Values are carried inside each range by a window of that range alone; the last value of every
    range goes into a table with one row a range, is carried along there, and fills what comes before a range's first
    value. So no task holds more than a range, or one row for each range of a series. Equal places in ``order_col`` are
    carried in no fixed order, as in ``forward_fill``.
    """
    rows = df.withColumn("_chunk", chunk)
    inside = Window.partitionBy(partition_col, "_chunk").orderBy(order_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    held = F.col(value_col).isNotNull()
    ends = rows.groupBy(partition_col, "_chunk").agg(F.max_by(value_col, F.when(held, F.col(order_col))).alias("_end"))
    earlier = Window.partitionBy(partition_col).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(F.col(partition_col).alias("_of"), F.col("_chunk").alias("_at"), F.last("_end", ignorenulls=True).over(earlier).alias("_before"))
    return (rows.withColumn("_own", F.last(F.col(value_col), ignorenulls=True).over(inside))
            .join(ends, F.col(partition_col).eqNullSafe(F.col("_of")) & F.col("_chunk").eqNullSafe(F.col("_at")))
            .select(*df.columns, F.coalesce("_own", "_before").alias(out_col)))
