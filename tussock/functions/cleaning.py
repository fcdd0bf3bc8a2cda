"""Typing and cleaning expressions for messy landing text.

All functions return ``Column`` expressions built from Spark built-ins, so they
stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text layout of datetimes written by the landing sink ('%Y-%m-%d %H:%M:%S').
LANDING_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Whitespace as a Python ``str.strip()`` sees it (Unicode aware).
_EDGE_SPACE = r"(?U)^\s+|\s+$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_nan(c: Column | str) -> Column:
    """NaN -> NULL. NaN must never reach comparisons: ``NaN > x`` is true in Spark."""
    c = _col(c)
    return F.nanvl(c, F.lit(None).cast("double"))


def strip_space(c: Column | str) -> Column:
    """Strip leading/trailing whitespace of any kind (``trim`` removes spaces only)."""
    return F.regexp_replace(_col(c), _EDGE_SPACE, "")


def coerce_double(c: Column | str) -> Column:
    """Coercing numeric parse: unparseable text -> NULL, NaN -> NULL."""
    return null_nan(strip_space(_col(c).cast("string")).try_cast("double"))


def try_int(c: Column | str) -> Column:
    """Coercing integer parse that accepts integral text such as ``'12.0'``.

    Spark's ``try_cast('12.0' as int)`` is NULL; warehouse engines round. Parse as
    double, round half-up, and let ``try_cast`` turn out-of-range values into NULL.
    """
    return F.round(coerce_double(c)).try_cast("int")


def strip_chars(c: Column | str, chars: str) -> Column:
    """Remove every occurrence of the given characters, then strip whitespace."""
    return strip_space(F.translate(_col(c), chars, ""))


def parse_money(c: Column | str) -> Column:
    """'$1,234,000' -> 1234000.0; anything unparseable -> NULL."""
    return coerce_double(strip_chars(c, "$,"))


def parse_percent(c: Column | str) -> Column:
    """'3.1%' -> 3.1; anything unparseable -> NULL."""
    return coerce_double(strip_chars(c, "%"))


def landing_date(c: Column | str, fmt: str = LANDING_TS_FORMAT) -> Column:
    """Strict date parse of landing timestamp text (raises on bad text under ANSI)."""
    return F.to_date(_col(c), fmt)


def try_landing_date(c: Column | str, fmt: str | None = None) -> Column:
    """Coercing date parse: unparseable text -> NULL."""
    c = _col(c).cast("string")
    if fmt is None:
        return F.try_to_timestamp(c).cast("date")
    return F.try_to_timestamp(c, F.lit(fmt)).cast("date")


def month_key(d: Column | str) -> Column:
    """First day of the month as DATE (``date_trunc`` would return a timestamp)."""
    return F.trunc(_col(d), "month")


def datetime_text(c: Column | str) -> Column:
    """Datetime -> landing text ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(_col(c), LANDING_TS_FORMAT)


def fold_columns(df: DataFrame, upper: bool = False) -> DataFrame:
    """Case-fold every column name (upper on landing, lower on serving)."""
    return df.toDF(*[(c.upper() if upper else c.lower()) for c in df.columns])


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by map; names absent from the frame are ignored, like a dict rename."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def select_positions(df: DataFrame, positions: list[int], names: list[str]) -> DataFrame:
    """Positional projection (``df[[0, 1, 7]]``) followed by a rename."""
    cols = df.columns
    return df.select(*[F.col(f"`{cols[i]}`") for i in positions]).toDF(*names)


def keep_columns(df: DataFrame, keep: list[str]) -> DataFrame:
    """Keep-list projection; a missing column fails loudly."""
    missing = [c for c in keep if c not in df.columns]
    if missing:
        raise KeyError(f"columns not in frame: {missing}")
    return df.select(*keep)


def with_audit(df: DataFrame, name: str = "ingested_at", at: Column | None = None) -> DataFrame:
    """Audit column; ``current_timestamp`` is one constant per query."""
    return df.withColumn(name, at if at is not None else F.current_timestamp())


def datetimes_as_text(df: DataFrame) -> DataFrame:
    """Export form: every timestamp/date column rendered as landing text."""
    out = []
    for f in df.schema.fields:
        t = f.dataType.typeName()
        if t in ("timestamp", "timestamp_ntz", "date"):
            out.append(datetime_text(F.col(f"`{f.name}`")).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def money_label(c: Column | str) -> Column:
    """Display form '$1,234,000' (no decimals)."""
    return F.concat(F.lit("$"), F.format_number(_col(c), 0))


def number_label(c: Column | str, decimals: int = 1) -> Column:
    """Display form with a fixed number of decimals, e.g. 3.1."""
    return F.format_string(f"%.{decimals}f", _col(c))


def month_label(d: Column | str) -> Column:
    """Display form 'Mar 2026'."""
    return F.date_format(_col(d), "MMM yyyy")
