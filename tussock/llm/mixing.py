"""Mixing sources to target weights: hash thresholds found in nested histograms."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import stored, whole_row

WORD = r"[^\x20\x09-\x0D]+"
#: Each level splits a bucket in 2 ** 12: three levels use 36 bits of a row's hash, two more those of its place.
BITS, LEVELS, PLACE_LEVELS = 12, 3, 2
#: The table of sources is broadcast up to this many sources, and joined by key beyond.
BROADCAST_SOURCES = 50_000


def targets(sources: DataFrame, weights=(5, 2, 1), cap: int = 3) -> DataFrame:
    """Add ``target`` to (source, source_size).

    Sources in code point order (null last) get the weights in turn and share all
    words by weight; a target stops at ``cap`` times the source's size and the excess is
    shared again by weight until none is above. That is one level ``lam`` with target
    ``min(cap * size, lam * weight)``, found from sums over the sources in order of
    ``cap * size / weight``. The table has one row a source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    i = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (i + 1).cast("int"))
    s = sources.select("source", "source_size", weight.alias("weight"))
    s = s.withColumn("ratio", cap * F.col("source_size") / F.col("weight"))
    up = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    prior = up.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.select(
        "*", F.row_number().over(up).alias("place"),
        ((F.sum("source_size").over(every) - F.coalesce(F.sum(cap * F.col("source_size")).over(prior), F.lit(0)))
         / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(prior), F.lit(0.0)))).alias("level"))
    s = s.withColumn("lam", F.min_by("level", F.when(F.col("level") <= F.col("ratio"), F.col("place"))).over(every))
    return s.select("source", "source_size",
                    F.least(cap * F.col("source_size").cast("double"), F.col("lam") * F.col("weight")).alias("target"))


def _size(text_col):
    return F.regexp_count(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit(WORD)).cast("long")


def _hash(id_col, text_col):
    """36 bits of the md5 of id and text, then 24 that tell equal rows apart by their place in the table."""
    whole = F.concat(*(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (id_col, text_col)))
    digits = F.conv(F.substring(F.md5(whole.cast("binary")), 1, BITS * LEVELS // 4), 16, 10).cast("long")
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << (BITS * PLACE_LEVELS)))
    return F.shiftleft(digits, BITS * PLACE_LEVELS) + place


def _copies(cap):
    h, at, before, inside, rest, whole = (F.col(c) for c in ("h", "at", "before", "inside", "rest", "whole"))
    more = (h < at) | ((h == at) & (before + inside / 2 <= rest))
    return F.least(whole + more.cast("long"), F.lit(cap).cast("long"))


def mixed_rows(docs: DataFrame, weights=(5, 2, 1), cap: int = 3, id_col: str = "doc_id", text_col: str = "text",
               source_col: str = "source") -> DataFrame:
    """The mix itself: every row of ``docs`` as often as ``mix`` takes it, with all its columns.

    Rows without words are taken as often as words of their hash would be. Rows find their
    threshold by a lookup and do not move. ``docs`` is read twice and has to come in the same order, as files do; else
    equal rows are taken in nearly the right number only.
    """
    _, edge, few = _thresholds(docs, weights, cap, id_col, text_col, source_col)
    rows = docs.select(whole_row(docs).alias("row"), F.col(source_col).alias("source"), _hash(id_col, text_col).alias("h"))
    rows = rows.join(F.broadcast(edge) if few else edge, F.col("source").eqNullSafe(F.col("s")))
    return (rows.select("row", _copies(cap).alias("copies")).filter("copies > 0")
            .select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*"))


def mix(docs: DataFrame, weights=(5, 2, 1), cap: int = 3, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> DataFrame:
    """How many words of each row the mix takes: 0 to ``cap`` whole copies.

    A source with target T and size S is taken floor(T / S) times whole; for the rest
    R = T - S * floor(T / S), rows are taken once more while their hash (of id and text) lies below a
    threshold. The threshold comes from a histogram of sizes by source and hash bucket;
    the bucket in which the running sum passes R is split again, and no row is
    sorted. Two further levels split rows of equal id and text, which are interchangeable, by their place in
    the table, so a lump of them is taken in part. At the last level (single rows) the boundary is taken if at least
    half of it fits into R.

    Returns id, ``source``, ``size`` (words; null text 0), ``source_size``, ``target``,
    ``copies`` and ``taken`` (copies * size). Null ids count as empty ones. Empty table: no rows. Further columns of
    ``docs`` are not read. Reruns agree on how often each (id, text) is taken.
    """
    base, edge, few = _thresholds(docs, weights, cap, id_col, text_col, source_col)
    copies = _copies(cap)
    return (base.join(F.broadcast(edge) if few else edge, F.col("source").eqNullSafe(F.col("s")))
            .select(F.col("id").alias(id_col), "source", "size", "source_size", "target", copies.alias("copies"),
                    (copies * F.col("size")).alias("taken")))


def _thresholds(docs, weights, cap, id_col, text_col, source_col):
    """(id, source, size, h of every row; the threshold of every source; whether it may be broadcast)."""
    base = stored(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), _size(text_col).alias("size"),
                              _hash(id_col, text_col).alias("h")), "mix-rows")
    goal = targets(base.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    edge = stored(goal.withColumn("whole", whole.cast("long"))
                  .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
                  .select(F.col("source").alias("s"), "source_size", "target", "whole", "rest",
                          F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("before"),
                          F.lit(0).cast("long").alias("inside")), "mix-sources")
    few = edge.count() <= BROADCAST_SOURCES

    def sided(e):
        return F.broadcast(e) if few else e

    width = BITS * (LEVELS + PLACE_LEVELS)
    for level in range(1, LEVELS + PLACE_LEVELS + 1):
        shift = width - BITS * level
        hist = (base.join(sided(edge.select("s", "at")), F.col("source").eqNullSafe(F.col("s")))
                .filter(F.shiftright("h", shift + BITS) == F.col("at"))
                .groupBy(F.col("source").alias("b_s"), F.shiftright("h", shift).alias("bucket"))
                .agg(F.sum("size").alias("words")))
        up = Window.partitionBy("b_s").orderBy("bucket")
        hist = hist.withColumn("past", F.sum("words").over(up))
        found = (hist.join(sided(edge.select("s", "rest", "before")), F.col("b_s").eqNullSafe(F.col("s")))
                 .filter(F.col("before") + F.col("past") > F.col("rest"))
                 .groupBy("b_s").agg(F.min(F.struct("bucket", "past", "words")).alias("cut")))
        edge = stored(
            edge.join(sided(found), F.col("b_s").eqNullSafe(F.col("s")), "left")
            .select("s", "source_size", "target", "whole", "rest",
                    F.coalesce("cut.bucket", F.shiftleft("at", BITS)).alias("at"),
                    F.coalesce(F.col("before") + F.col("cut.past") - F.col("cut.words"), F.col("before")).alias("before"),
                    F.coalesce("cut.words", F.lit(0)).cast("long").alias("inside")), f"mix-edge{level}")
    return base, edge, few
