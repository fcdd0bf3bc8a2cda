"""Fixed-size tables of counters, filled in tasks and merged in tasks."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tables are cut into so many pieces and merged so many tasks at a time.
PIECES, FAN = 16, 32


def packed(counts: np.ndarray) -> list[bytes]:
    """The pieces of a task's table; its length must be a multiple of ``PIECES``."""
    return [zlib.compress(p.astype(np.uint32).tobytes(), 1) for p in np.split(counts, PIECES)]


def _add(table):
    import pyarrow as pa

    total = None
    for raw in table.column("counts").to_pylist():
        part = np.frombuffer(zlib.decompress(raw), np.uint32).astype(np.uint64)
        total = part if total is None else total + part
    total = np.minimum(total, np.uint64(2 ** 32 - 1)).astype(np.uint32)
    return pa.table({"piece": table.column("piece")[:1], "task": table.column("task")[:1],
                     "counts": pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())})


def merged(parts: DataFrame, tasks: int, size: int) -> np.ndarray:
    """Sum of the tables in (piece int, task long, counts binary), as one array of ``size``.

    ``FAN`` tasks' tables meet in one reduce group at a time, until one is left; only that one, of a
    size that doesn't depend on the data, reaches the driver. Counters stop at 2 ** 32 - 1.
    """
    parts = parts.select("piece", "task", "counts")
    while True:
        parts = (parts.withColumn("task", F.floor(F.col("task") / FAN)).groupBy("piece", "task")
                 .applyInArrow(_add, "piece int, task long, counts binary"))
        tasks = -(-tasks // FAN)
        if tasks <= 1:
            break
    out = np.zeros((PIECES, size // PIECES), np.uint32)
    for r in parts.collect():
        out[r.piece] += np.frombuffer(zlib.decompress(bytes(r.counts)), np.uint32)
    return out.ravel()
