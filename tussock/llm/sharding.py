"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import stored

WORD = r"[^\x20\x09-\x0D]+"
#: Hash buckets of each level; a level takes this share of the small groups, so the last items are fine.
BUCKETS_A_LEVEL, LEVELS = 2048, 4
#: A group is placed by itself from this part of a shard in bytes, tokens or rows.
LARGE = 1 / 64
#: A group over one shard is cut into pieces of about this part of a shard.
PIECE = 1 / 8
SLOTS_A_TASK = 4096


def place(items: list[tuple], capacity: np.ndarray, n_shards: int) -> list[int]:
    """The shard of each item (its vector is item[1:]).

    Items come in order of their largest share of a shard; each goes where the dot
    product of its vector with the residual capacity is highest (ties: lowest shard).
    """
    if not items:
        return []
    size = np.array([x[1:] for x in items], dtype=float) / np.maximum(capacity, 1e-9)
    order = sorted(range(len(items)), key=lambda i: (-size[i].max(), items[i][0]))
    residual, shard = np.ones((n_shards, size.shape[1])), [0] * len(items)
    for i in order:
        shard[i] = int(np.argmax(residual @ size[i]))
        residual[shard[i]] -= size[i]
    return shard


def _bucket(group: Column) -> Column:
    """Hash bucket of a small group: half of them in level 0, a quarter in level 1 and so on."""
    u = F.pmod(F.xxhash64(group, F.lit("level")), F.lit(1 << (LEVELS - 1)))
    level = F.lit(LEVELS - 1)
    for k in reversed(range(LEVELS - 1)):
        level = F.when(u >= (1 << (LEVELS - 2 - k)), F.lit(k)).otherwise(level)
    return (level * BUCKETS_A_LEVEL + F.pmod(F.xxhash64(group), F.lit(BUCKETS_A_LEVEL))).cast("long")


def shard(docs: DataFrame, n_shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Assign every row to a shard, with near-equal bytes, tokens and rows a shard.

    Groups are rows of equal text and stay together, unless a group exceeds a whole
    shard in bytes, tokens or rows; such a group is cut by a hash of id and place in the table into
    pieces of about an eighth of a shard. Groups (or pieces) of at least 1/64 of a shard are
    placed one by one, at most 3 * 64 * ``n_shards`` of them plus pieces; all smaller
    groups are placed with the others of their hash bucket (8,192 buckets). So the
    placement on the driver handles a number of items that does not depend on the
    data, and rows find their shard by a broadcast lookup without moving.

    Returns id, ``size`` (UTF-8 bytes + 8), ``text_crc32``, ``tokens``, ``group`` (hash of
    the text), ``shard`` and ``slot`` (gapless from 0 within a shard). Null text: no bytes,
    own group. Rows with null or repeated ids are rows like any other and are cut apart like them.
    An empty table gives no rows; further columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = stored(docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).alias("crc"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("tokens"),
        F.xxhash64(F.col(text_col).isNull(), F.col(text_col)).alias("grp"),
        F.monotonically_increasing_id().alias("place")), "shard-rows")

    sums = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("n")]
    total = np.array([x or 0 for x in base.agg(*sums).first()], dtype=float)
    capacity = np.maximum(total / n_shards, 1e-9)
    share = F.greatest(*(F.col(c) / F.lit(float(k)) for c, k in zip(("size", "tokens", "n"), capacity)))
    groups = base.groupBy("grp").agg(*sums).withColumn("share", share)
    large = [(r.grp, r.share) for r in groups.filter(F.col("share") >= LARGE).select("grp", "share").collect()]
    cuts = {g: max(1, int(np.ceil(s / PIECE))) if s > 1 else 1 for g, s in large}
    known = F.broadcast(spark.createDataFrame(list(cuts.items()) or [(None, 1)], "l_grp long, pieces long"))
    # The stored place tells rows of equal id and text apart, which may go anywhere.
    piece = F.pmod(F.xxhash64("id", "place"), F.col("pieces"))
    rows = (base.join(known, F.col("grp") == F.col("l_grp"), "left")
            .withColumn("a", F.when(F.col("l_grp").isNull(), F.lit(-1).cast("long")).otherwise(piece))
            .withColumn("b", F.when(F.col("l_grp").isNull(), _bucket(F.col("grp"))).otherwise(F.col("grp")))
            .drop("l_grp", "pieces"))
    items = [((r.a, r.b), r.size, r.tokens, r.n) for r in rows.groupBy("a", "b").agg(*sums).collect()]
    where = [(a, b, s) for ((a, b), *_), s in zip(items, place(items, capacity, n_shards))]
    table = F.broadcast(spark.createDataFrame(where or [(None, None, 0)], "p_a long, p_b long, shard int"))
    rows = (rows.join(table, (F.col("a") == F.col("p_a")) & (F.col("b") == F.col("p_b")))
            .withColumn("block", F.pmod(F.xxhash64("id", "grp", "place"),
                                        F.lit(int(total[2] // (n_shards * SLOTS_A_TASK)) + 1))))
    counts = rows.groupBy("shard", "block").count()
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "block", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "block").orderBy("id", "grp", "place")
    return (rows.withColumn("rank", F.row_number().over(within))
            .join(offsets, ["shard", "block"])
            .select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "tokens",
                    F.col("grp").alias("group"), "shard",
                    (F.col("offset") + F.col("rank") - 1).cast("long").alias("slot")))
