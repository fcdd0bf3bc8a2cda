"""Embedding whitening from a covariance found by polarisation, in exact integers."""

from __future__ import annotations

from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import stored

#: Partial sums are merged this many tasks at a time.
FAN = 32
#: Squares are summed in three limbs of so many bits; centred values stay below 2 ** (2 * LIMB).
LIMB = 24
MASK = np.int64((1 << LIMB) - 1)
#: Rows worked on at once, so that no limb can overflow.
ROWS = 4096
#: Eigenvalues up to this part of the largest one count as zero.
TINY = 1e-12


def matrix(column, dim):
    """(n, dim) array of a batch of vectors that all have ``dim`` entries."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def limbs_of_squares(d):
    """Squares of whole numbers below 2 ** 48 as (high, middle, low): high * 2 ** 48 + middle * 2 ** 24 + low."""
    high, low = d >> LIMB, d & MASK
    return high * high, 2 * high * low, low * low


def carried(high, middle, low):
    """The same numbers with middle and low limbs below 2 ** 24."""
    middle = middle + (low >> LIMB)
    return high + (middle >> LIMB), middle & MASK, low & MASK


def exact(high, middle, low):
    return [(int(a) << (2 * LIMB)) + (int(b) << LIMB) + int(c) for a, b, c in zip(high, middle, low)]


def pair_order(dim):
    """The pairs (i, j), i <= j, in the order of the sums; (i, i) stands for the dimension itself."""
    return [(i, j) for i in range(dim) for j in range(i, dim)]


def squares(d):
    """Limbs of the sums over rows of d_i ** 2 and (d_i + d_j) ** 2, in the order of ``pair_order``."""
    parts = []
    for i in range(d.shape[1]):
        both = d[:, i:] + d[:, i:i + 1]
        both[:, 0] = d[:, i]
        parts.append(np.stack([x.sum(0) for x in limbs_of_squares(both)]))
    return carried(*np.concatenate(parts, axis=1)) if parts else (np.zeros(0, np.int64),) * 3


def covariance(sums, n, dim):
    """The covariance matrix of x (divisor n) from the exact sums of squares of n * x - S.

    A pair's cross term is half the difference between the square of the sum and the two squares,
    taken in whole numbers; only the last division rounds.
    """
    q = dict(zip(pair_order(dim), sums))
    out = np.zeros((dim, dim))
    for (i, j), s in q.items():
        cross = s if i == j else Fraction(s - q[i, i] - q[j, j], 2)
        out[i, j] = out[j, i] = float(Fraction(cross) / n ** 3)
    return out


def _totals(dim):
    """Per task: rows and sums of the vectors."""
    def run(batches):
        import pyarrow as pa

        n, total = 0, np.zeros(dim, np.int64)
        for b in batches:
            x = matrix(b.column("x"), dim)
            n, total = n + len(x), total + x.sum(0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([total.tolist()], pa.list_(pa.int64()))], names=["n", "total"])
    return run


def _squared(dim, n, total):
    """Per task: the limbs of all sums of squared centred values."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        s, acc = np.array(total, np.int64), None
        for b in batches:
            x = matrix(b.column("x"), dim)
            for at in range(0, len(x), ROWS):
                d = n * x[at:at + ROWS] - s
                if np.abs(d).max() >= 1 << (2 * LIMB - 1):
                    raise OverflowError("centred values beyond 2 ** 47: use a smaller scale")
                part = squares(d)
                acc = part if acc is None else carried(*(a + p for a, p in zip(acc, part)))
        if acc is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()),
                                              *(pa.array([a.tobytes()], pa.binary()) for a in acc)], names=["task", "high", "middle", "low"])
    return run


def _add_limbs(table):
    import pyarrow as pa

    cols = [sum(np.frombuffer(x, np.int64) for x in table.column(c).to_pylist()) for c in ("high", "middle", "low")]
    return pa.table({"task": table.column("task")[:1], **{c: pa.array([a.tobytes()], pa.binary())
                                                          for c, a in zip(("high", "middle", "low"), carried(*cols))}})


def _tree(parts: DataFrame, add, schema: str, tasks: int):
    """All tasks' rows added up, ``FAN`` at a time; the one row that is left, or None."""
    while True:
        parts = parts.withColumn("task", F.floor(F.col("task") / FAN)).groupBy("task").applyInArrow(add, schema)
        tasks = -(-tasks // FAN)
        if tasks <= 1:
            return parts.collect()[0]


def projected(x, n, total, vectors, values):
    """x - S / n on the components, over the root of their eigenvalues; NaN where that is zero."""
    centred = (n * x - np.array(total, np.int64)) / n
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(values > 0, centred @ vectors / np.sqrt(np.where(values > 0, values, 1)), np.nan)


def _products(dim, n, total, vectors, values):
    """Per task: sums of the products of the whitened components, over the fit list."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        acc = None
        for b in batches:
            w = projected(matrix(b.column("x"), dim), n, total, vectors, values)
            acc = w.T @ w if acc is None else acc + w.T @ w
        if acc is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([acc.tobytes()], pa.binary())],
                                             names=["task", "sums"])
    return run


def _add_products(table):
    import pyarrow as pa

    total = sum(np.frombuffer(x, np.float64) for x in table.column("sums").to_pylist())
    return pa.table({"task": table.column("task")[:1], "sums": pa.array([total.tobytes()], pa.binary())})


def _rows(dim, n, total, vectors, values):
    """One row for each vector and component."""
    def run(batches):
        import pyarrow as pa

        k, s = len(values), np.array(total, np.int64)
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                part = b.slice(at, ROWS)
                x = matrix(part.column("x"), dim)
                high, middle, low = carried(*(v.sum(1) for v in limbs_of_squares(n * x - s)))
                fits = high < (1 << (63 - 2 * LIMB))
                deviation = np.where(fits, (np.where(fits, high, 0) << (2 * LIMB)) + (middle << LIMB) + low, 0)
                w = projected(x, n, total, vectors, values).ravel()
                which = np.repeat(np.arange(len(x)), k)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(which)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                     pa.array(deviation[which], mask=~fits[which]), pa.array(w, mask=np.isnan(w))],
                    names=["id", "component", "deviation", "whitened"])
    return run


def whiten(vectors: DataFrame, components: int = 16, id_col: str = "vec_id", vec_col: str = "embedding",
           scale: float = 64.0, shift: int = 1_000_000) -> DataFrame:
    """Whitened principal components of every vector, fitted on the distinct quantised vectors.

    Entries become whole numbers x = floor(scale * entry) + shift. The fit list is each distinct x vector
    once (n of them, sums S). One pass sums the squares of n * x_i - S_i for every dimension and of
    (n * x_i - S_i) + (n * x_j - S_j) for every pair, in whole numbers of three limbs, merged as a tree of tasks. By
    polarisation, half of what a pair's square exceeds the two single ones is the cross term, so all covariances
    follow without rounding until the last division; the dim x dim matrix goes to ``eigh`` on the driver.

    Returns id, ``component`` (from 1, falling eigenvalue), ``n``, ``deviation`` (sum of (n * x - S) ** 2),
    ``whitened``, ``explained`` (eigenvalue over trace) and ``identity_error`` (largest entry of the whitened fit
    list's covariance minus the identity), one row for each usable vector and component.

    Rows whose vector is null or holds null or non-finite entries are left out; an empty vector has no
    entries and, like missing entries of shorter vectors, counts as zeros. Null ids and repeated rows stay, each
    with its own rows. Components whose eigenvalue is zero (up to rounding) have null ``whitened`` and take no part
    in ``identity_error`` (null if all are zero, as for one distinct vector); a ``deviation`` beyond a long is null. An empty
    table, or one of empty vectors, gives no rows; further columns are not read.
    """
    v = F.col(vec_col)
    ok = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < float("inf")))
    usable = vectors.filter(v.isNotNull() & F.coalesce(ok, F.lit(False)))
    kind = usable.select(id_col).schema[0].dataType.simpleString()
    dim = usable.agg(F.max(F.size(v))).first()[0] or 0
    x = F.transform(v, lambda e: F.floor(F.lit(scale) * e.cast("double")).cast("long") + F.lit(shift).cast("long"))
    x = F.concat(x, F.array_repeat(F.lit(shift).cast("long"), F.lit(dim) - F.size(v)))
    rows = usable.select(F.col(id_col).alias("id"), x.alias("x"))
    schema = f"id {kind}, component int, deviation long, whitened double"
    out = ["n", "deviation", "whitened", "explained", "identity_error"]
    if not dim:
        empty = vectors.sparkSession.createDataFrame([], schema + ", n long, explained double, identity_error double")
        return empty.select(F.col("id").alias(id_col), "component", *out)
    fit = stored(rows.select("x").distinct(), "white-fit")
    sums = fit.mapInArrow(_totals(dim), "n long, total array<long>").agg(
        F.sum("n").alias("n"), *(F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dim))).first()
    n, total = int(sums["n"]), [int(sums[f"s{i}"]) for i in range(dim)]
    tasks = fit.rdd.getNumPartitions()
    parts = fit.mapInArrow(_squared(dim, n, total), "task long, high binary, middle binary, low binary")
    q = _tree(parts, _add_limbs, "task long, high binary, middle binary, low binary", tasks)
    cov = covariance(exact(*(np.frombuffer(bytes(q[c]), np.int64) for c in ("high", "middle", "low"))), n, dim)
    values, basis = np.linalg.eigh(cov)
    values, basis = values[::-1], basis[:, ::-1]
    trace, k = float(np.trace(cov)), min(components, dim)
    top = np.where(values[:k] > TINY * max(values[0], 0), values[:k], 0.0)
    basis = np.ascontiguousarray(basis[:, :k])
    share = [float(e) / trace if trace > 0 else None for e in top]
    some = np.flatnonzero(top)
    error = None
    if len(some):
        parts = fit.mapInArrow(_products(dim, n, total, basis[:, some], top[some]), "task long, sums binary")
        got = np.frombuffer(bytes(_tree(parts, _add_products, "task long, sums binary", tasks)["sums"]), np.float64)
        error = float(np.abs(got.reshape(len(some), -1) / n - np.eye(len(some))).max())
    explained = F.element_at(F.array(*(F.lit(e).cast("double") for e in share)), F.col("component"))
    done = rows.mapInArrow(_rows(dim, n, total, basis, top), schema)
    return (done.withColumns({"n": F.lit(n).cast("long"), "explained": explained, "identity_error": F.lit(error).cast("double")})
            .select(F.col("id").alias(id_col), "component", *out))
