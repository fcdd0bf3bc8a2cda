"""Near-duplicate embeddings by product quantisation over coarse inverted lists."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .store import stored

#: Centroids and codewords are fitted on at most so many vectors, and so many numbers.
FIT_ROWS, FIT_NUMBERS = 20_000, 1 << 24
#: Vectors for each coarse list, and the most lists (a fixed size of the broadcast model).
LIST_VECTORS, MOST_LISTS = 2048, 1024
#: Dimensions of a subspace, and codewords of each.
SUB, WORDS = 4, 256
ROUNDS = 8
#: Lists are probed as far as a link could reach: so many standard deviations of a link's length along one direction.
REACH = 4.0
#: Angles to a list's centroid are told apart by so many steps of pi.
STEPS = 2048
#: Vectors of a list that meet in one task at a time; larger lists are cut into blocks, and every two blocks meet.
BLOCK = 4096
#: Pairs worked on at once.
PAIRS = 1 << 16


def unit(x):
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def means(x, k, rng, spherical):
    """k-means of the rows of x: centroids of unit length if ``spherical``."""
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(ROUNDS):
        own = np.argmax(x @ c.T - (0 if spherical else 0.5 * (c * c).sum(1)), axis=1)
        size = np.bincount(own, minlength=len(c))
        total = np.stack([np.bincount(own, weights=x[:, d], minlength=len(c)) for d in range(x.shape[1])], axis=1)
        c = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], c)
        if spherical:
            length = np.sqrt((c * c).sum(1, keepdims=True))
            c = np.where(length > 0, c / np.where(length > 0, length, 1), x[:1])
    return c


class Model:
    """Coarse centroids and, for the residuals, the codewords of each subspace."""

    def __init__(self, sample, lists, least, seed=7):
        rng = np.random.default_rng(seed)
        self.least = least
        self.radius = math.sqrt(max(2 - 2 * least, 0))
        self.lists = means(sample, lists, rng, True)
        self.dim = sample.shape[1]
        self.cuts = list(range(0, self.dim, SUB)) + [self.dim]
        residual = sample - self.lists[np.argmax(sample @ self.lists.T, axis=1)]
        self.words = [means(np.ascontiguousarray(residual[:, a:b]), WORDS, rng, False) for a, b in zip(self.cuts, self.cuts[1:])]
        gap = np.sqrt(np.maximum(2 - 2 * self.lists @ self.lists.T, 0))
        self.slack = self.radius * gap * min(1.0, REACH / math.sqrt(self.dim))

    def assign(self, x):
        """(own list, cosines to all centroids, lists to be probed) of unit vectors. Only lists before the own one are
        probed: a pair in lists a < b is found when the one in b probes a."""
        cos = x @ self.lists.T
        own = np.argmax(cos, axis=1)
        at = np.arange(len(x))
        probes = cos[at, own][:, None] - cos <= self.slack[own]
        probes &= np.arange(len(self.lists))[None, :] < own[:, None]
        return own, cos, probes

    def encode(self, x, own):
        """Codes of the residuals and the length of what they leave out."""
        r = x - self.lists[own]
        codes, miss = np.zeros((len(x), len(self.words)), np.uint8), np.zeros(len(x))
        for s, (a, b, w) in enumerate(zip(self.cuts, self.cuts[1:], self.words)):
            codes[:, s] = np.argmax(r[:, a:b] @ w.T - 0.5 * (w * w).sum(1), axis=1)
            miss += ((r[:, a:b] - w[codes[:, s]]) ** 2).sum(1)
        return codes, np.sqrt(miss)

    def tables(self, y, own):
        """For every y the squared distances of its residual to all codewords, by subspace."""
        r = y - self.lists[own]
        return [((r[:, a:b] ** 2).sum(1)[:, None] - 2 * r[:, a:b] @ w.T + (w * w).sum(1)) for a, b, w in zip(self.cuts, self.cuts[1:], self.words)]


def step_of(cos):
    return np.minimum(np.arccos(np.clip(cos, -1, 1)) * (STEPS / math.pi), STEPS - 1).astype(np.int32)


def sure_steps(least):
    """Two vectors whose steps add up to at most this are linked, whatever their directions from the centroid."""
    return math.floor(math.acos(min(max(least, -1), 1)) * STEPS / math.pi - 1e-6) - 2


def apart_steps(least):
    """Two vectors whose steps differ by more than this can't be linked."""
    return math.ceil(math.acos(min(max(least, -1), 1)) * STEPS / math.pi + 1e-6) + 1


ENTRY = "label string, list int, step int, own boolean, key long, copies long, vec binary, code binary, miss double"


def _entries(model, dim):
    """Each vector as an entry of its own list and a visitor of the lists it probes."""
    def run(batches):
        import pyarrow as pa

        m = model.value
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                raw = part.column("vec").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
                x = unit(raw)
                own, cos, probes = m.assign(x)
                probes[np.arange(len(x)), own] = True
                row, lists = np.nonzero(probes)
                mine = lists == own[row]
                codes, miss = m.encode(x, own)
                packed = [v.tobytes() for v in raw]
                none = b""
                yield pa.RecordBatch.from_arrays(
                    [part.column("label").take(pa.array(row)), pa.array(lists.astype(np.int32)), pa.array(step_of(cos[row, lists])), pa.array(mine),
                     part.column("key").take(pa.array(row)), part.column("copies").take(pa.array(row)), pa.array([packed[i] for i in row], pa.binary()),
                     pa.array([codes[i].tobytes() if o else none for i, o in zip(row, mine)], pa.binary()), pa.array(np.where(mine, miss[row], 0.0))],
                    names=[f.split()[0] for f in ENTRY.split(", ")])
    return run


def _steps(least):
    """What the steps of one list decide: sure links by step, and whose links have to be looked for."""
    def run(pdf):
        import pandas as pd

        pdf = pdf.sort_values("step")
        step = pdf["step"].to_numpy()
        sure, apart = sure_steps(least), apart_steps(least)
        own, visiting = np.zeros(STEPS + 1, np.int64), np.zeros(STEPS + 1, np.int64)
        rows = {True: np.zeros(STEPS + 1, np.int64), False: np.zeros(STEPS + 1, np.int64)}
        own[step + 1], visiting[step + 1] = pdf["own_copies"], pdf["visiting_copies"]
        rows[True][step + 1], rows[False][step + 1] = pdf["own_rows"], pdf["visiting_rows"]
        own, visiting, rows = np.cumsum(own), np.cumsum(visiting), {k: np.cumsum(v) for k, v in rows.items()}
        upto = np.clip(sure - step + 1, 0, STEPS)
        low = np.maximum(upto, np.clip(step - apart, 0, STEPS))
        high = np.maximum(low, np.clip(step + apart + 1, 0, STEPS))
        open_own, open_visiting = (rows[k][high] - rows[k][low] for k in (True, False))
        with_own = open_own > 0
        first = pdf.loc[pdf["own_rows"] > 0]
        pivot, at = (int(first["first_key"].iloc[0]), int(first["step"].iloc[0])) if len(first) else (0, 2 * STEPS)
        asks_own = with_own | (open_visiting > 0)
        total = int(pdf["own_rows"].to_numpy()[asks_own].sum() + pdf["visiting_rows"].to_numpy()[with_own].sum())
        return pd.DataFrame({"label": pdf["label"], "list": pdf["list"], "step": step, "sure_own": own[upto], "sure_visiting": visiting[upto],
                             "pivot": pivot, "to_pivot": step + at <= sure, "own_asks": asks_own, "visitor_asks": with_own, "open_rows": total})
    return run


def roots(n, a, b):
    """Smallest index of each one's component, for pairs of indexes."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _meet(model, dim):
    """Links of one pair of blocks: for each entry how many it has here, and one it is connected with."""
    def run(table):
        import pyarrow as pa

        m = model.value
        key, copies, step, block = (table.column(c).to_numpy() for c in ("key", "copies", "step", "block"))
        own = table.column("own").to_numpy(zero_copy_only=False).astype(bool)
        raw = np.frombuffer(b"".join(table.column("vec").to_pylist()), np.float64).reshape(-1, dim)
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        length = np.sqrt((raw * raw).sum(1))
        x = unit(raw)
        here = int(table.column("list")[0].as_py())
        held = np.flatnonzero(own)
        found = np.zeros(len(key), np.int64)
        left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if len(held):
            codes = np.frombuffer(b"".join(table.column("code").take(pa.array(held)).to_pylist()), np.uint8).reshape(len(held), -1)
            near = m.radius + table.column("miss").to_numpy()[held] + 1e-9
            near, sure, apart = near * near, sure_steps(m.least), apart_steps(m.least)
            width = max(1, PAIRS * 4 // len(held))
            for at in range(0, len(key), width):
                ask = np.arange(at, min(at + width, len(key)))
                far = sum(t[:, codes[:, s]] for s, t in enumerate(m.tables(x[ask], here)))
                may = far <= near[None, :]
                gap = step[held][None, :] - step[ask][:, None]
                may &= (step[held][None, :] + step[ask][:, None] > sure) & (np.abs(gap) <= apart)
                if i != j:
                    may &= block[held][None, :] != block[ask][:, None]
                # Two entries of the list meet once, from the later one; a visitor meets every entry.
                may &= ~own[ask][:, None] | (held[None, :] < ask[:, None])
                p, q = np.nonzero(may)
                for k in range(0, len(p), PAIRS):
                    a, b = ask[p[k:k + PAIRS]], held[q[k:k + PAIRS]]
                    cos = (raw[a] * raw[b]).sum(1) / (length[a] * length[b])
                    ok = cos >= m.least
                    a, b = a[ok], b[ok]
                    np.add.at(found, a, copies[b])
                    np.add.at(found, b, copies[a])
                    left.append(a)
                    right.append(b)
        root = roots(len(key), np.concatenate(left), np.concatenate(right))
        some = found > 0
        return pa.table({"key": key[some], "n": found[some], "other": key[root[some]]})
    return run


def embedding_links(vectors: DataFrame, least: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """Links of vectors with equal labels and a cosine of at least ``least``, and their components.

    1. Equal vectors of a label become one class with a count. A model is fitted on at most 20,000 classes, chosen
       by hash: unit centroids of the coarse lists (one for 2,048 classes, 1,024 at most) and 256 codewords for
       every four dimensions of the residuals.
    2. Every class enters the list of its nearest centroid with its code, and visits the earlier lists whose
       bisecting plane is near enough: a link is a step of at most sqrt(2 - 2 * ``least``), and it may spend four standard deviations of
       a randomly directed step across that plane. Only links stretched further than that along that very direction are missed.
    3. The angles to the centroid decide what they can: two vectors whose angles add up to the link angle at most
       are linked, two whose angles differ by more are not. So a dense group costs counts by angle, not pairs.
    4. For the rest, distances of the visitor's exact residual to the codes come from lookup tables; a pair stays if that
       distance is within the link distance plus the code's own error, which loses none, and its exact cosine in
       double precision decides. Lists of more than 4,096 vectors are cut into blocks, and every two blocks meet.

    Returns id, ``n_links`` (other vectors linked directly), ``component_id`` (smallest id reachable, itself included) and ``kept``
    (the id is its component's) for every row. Null, empty and zero vectors, those with null or non-finite components, and
    rows with a null label link with nothing. Missing entries of shorter vectors count as zeros. Rows that repeat an id are
    vectors each; null ids take part and are never the smallest, and a row without an id is kept if its component has
    none. An empty table gives no rows; further columns are not read.
    """
    spark = vectors.sparkSession
    v, label = F.col(vec_col), F.col(label_col)
    fine = F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) < float("inf")))
    usable = label.isNotNull() & v.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(v, lambda e: e != 0)
    dim = vectors.filter(usable).agg(F.max(F.size(v))).first()[0] or 0
    vec = F.concat(F.transform(v, lambda e: e.cast("double") + 0.0), F.array_repeat(F.lit(0.0), F.lit(dim) - F.size(v)))
    vec = F.when(F.coalesce(usable, F.lit(False)), vec)
    rows = vectors.select(F.col(id_col).alias("id"), label.cast("string").alias("label"), vec.alias("vec"))
    rows = rows.withColumn("key", F.when(F.col("vec").isNotNull(), F.xxhash64("label", "vec")))
    if not dim:
        return _linked(rows.select("id", "key"), None, None, None, id_col)
    base = stored(rows.select("id", "key"), "pq-rows")
    classes = stored(rows.filter("key is not null").groupBy("key", "label", "vec").agg(
        F.count("*").alias("copies"), F.min("id").alias("first_id")), "pq-classes")
    n = classes.count()
    most = max(1, min(FIT_ROWS, FIT_NUMBERS // dim))
    share = min(1.0, most / n)
    drawn = classes.filter(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int(share * (1 << 30))).select("vec").limit(most).toArrow()
    if not drawn.num_rows:
        drawn = classes.select("vec").limit(most).toArrow()
    sample = drawn.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    sample = sample[np.lexsort(sample.T)]
    model = spark.sparkContext.broadcast(Model(unit(sample), max(1, min(MOST_LISTS, n // LIST_VECTORS, len(sample))), least))
    entries = stored(classes.select("key", "label", "vec", "copies").mapInArrow(_entries(model, dim), ENTRY), "pq-entries")
    steps = entries.groupBy("label", "list", "step").agg(
        F.sum(F.when(F.col("own"), F.col("copies")).otherwise(0)).alias("own_copies"),
        F.sum(F.when(F.col("own"), 0).otherwise(F.col("copies"))).alias("visiting_copies"),
        F.count_if("own").alias("own_rows"), F.count_if(~F.col("own")).alias("visiting_rows"),
        F.min(F.when(F.col("own"), F.col("key"))).alias("first_key"))
    told = stored(steps.fillna(0, ["first_key"]).groupBy("label", "list").applyInPandas(
        _steps(least), "label string, list int, step int, sure_own long, sure_visiting long, pivot long, to_pivot boolean, own_asks boolean, "
        "visitor_asks boolean, open_rows long"), "pq-steps")
    both = entries.join(told, ["label", "list", "step"])
    itself = F.when(2 * F.col("step") <= sure_steps(least), F.col("copies")).otherwise(0)
    sure = both.select("key", (F.col("sure_own") + F.when(F.col("own"), F.col("sure_visiting") - itself).otherwise(0)).alias("n"),
                       F.when(F.col("to_pivot"), F.col("pivot")).otherwise(F.col("key")).alias("other")).filter("n > 0")
    asks = both.filter((F.col("own") & F.col("own_asks")) | (~F.col("own") & F.col("visitor_asks")))
    blocks = F.ceil(F.col("open_rows") / BLOCK)
    asks = asks.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")))
    asks = asks.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    tiles = asks.select("label", "list", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "step", "own",
                        "key", "copies", "vec", "code", "miss")
    met = tiles.groupBy("label", "list", "i", "j").applyInArrow(_meet(model, dim), "key long, n long, other long")
    links = stored(sure.unionByName(met), "pq-links")
    return _linked(base, classes, links, connected_components(links.select(F.col("key").alias("a"), F.col("other").alias("b"))), id_col)


def _linked(base, classes, links, labels, id_col):
    """The result rows from (key, n) of links and (node, label) of components."""
    if classes is None:
        base = base.withColumns({"n_links": F.lit(0).cast("long"), "least_id": F.col("id")})
    else:
        count = links.groupBy("key").agg(F.sum("n").alias("n"))
        known = (classes.select("key", "copies", "first_id").join(count, "key", "left")
                 .join(labels.select(F.col("node").alias("key"), "label"), "key", "left").withColumn("label", F.coalesce("label", "key")))
        known = stored(known.select("key", "label", "first_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "pq-known")
        least_id = known.groupBy("label").agg(F.min("first_id").alias("least_id"))
        known = known.join(least_id, "label").select("key", "n_links", "least_id")
        base = (base.join(known, "key", "left").withColumn("least_id", F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("least_id"))))
    return base.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                       F.col("least_id").alias("component_id"), F.col("id").eqNullSafe(F.col("least_id")).alias("kept"))
