"""Toxicity scores from a convolutional text classifier, trained and applied in numpy inside tasks."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import sided, stored, whole_row
from .textbytes import Hasher, buffers, letter_bounds, lower, slices

BUCKETS, DIM, WIDTHS, FILTERS = 1 << 16, 6, (1, 2, 3), 6
#: A word is embedded as itself plus its beginnings of these lengths, so unseen endings of a known stem are known.
STEM_BYTES = (4, 5, 7)
VIEWS = len(STEM_BYTES) + 1
#: Labelled rows of a label to learn from; None: all of them.
TRAIN_ROWS = None
#: Rows are learnt from in parts of so many bytes of text, each by one task, whose changes are averaged.
PART_BYTES = 1 << 25
#: Passes over the rows of a part, and over all parts where there are several, once each.
EPOCHS, ROUNDS = 6, 2
#: Texts of a step, fewer if they hold more tokens.
BATCH, BATCH_TOKENS, RATE = 64, 1 << 18, 0.05
#: Changes are added up as whole numbers of this unit, so that their sum has no order.
UNIT = 2.0 ** -28
#: A bucket's log-odds are shrunk as if so many more texts held it without a tendency.
SHRINK = 10
DEFAULT_THRESHOLD = 0.3


def token_ids(hasher, data, offsets):
    """(first token of each text plus the total, buckets by view and token) of whole texts."""
    starts, ends = letter_bounds(data, offsets)
    first = np.searchsorted(starts, offsets, side="left")
    prefix = hasher.prefix(lower(data))
    ids = np.empty((VIEWS, len(starts)), np.int32)
    ids[0] = hasher.spans(prefix, starts, ends) % np.uint64(BUCKETS)
    for k, n in enumerate(STEM_BYTES):
        ids[k + 1] = hasher.spans(prefix, starts, np.minimum(ends, starts + n)) % np.uint64(BUCKETS)
    return first, ids


def _shifted(x, j, left):
    """Row i is x[i + j], or zero where that lies in the next text (``left``: tokens left from i on)."""
    if j == 0:
        return x
    out = np.zeros_like(x)
    out[:-j] = x[j:]
    out[left <= j] = 0
    return out


def _steps(order, sizes):
    """``order`` in runs of at most ``BATCH`` texts and, but for a single text, ``BATCH_TOKENS`` tokens."""
    for at in range(0, len(order), BATCH):
        batch = order[at:at + BATCH]
        part = np.cumsum(sizes[batch]) // BATCH_TOKENS
        yield from np.split(batch, np.flatnonzero(np.diff(part)) + 1)


class Network:
    """Hashed embeddings, filters of several widths, max pooling over the text, a logistic unit."""

    def __init__(self, rng=None):
        rng = rng or np.random.default_rng(0)
        self.words = rng.normal(0, 0.02, (BUCKETS, DIM))
        self.filters = {w: rng.normal(0, 0.1, (w, DIM, FILTERS)) for w in WIDTHS}
        for w in WIDTHS:
            self.filters[w][:, 0, :] = np.abs(self.filters[w][:, 0, :]) + 0.5 / w
        self.bias = np.zeros((len(WIDTHS), FILTERS))
        self.out = np.full((len(WIDTHS), FILTERS), 0.2)
        self.out_bias = -1.5

    def start_from_counts(self, seen, n):
        """Set the first embedding component to a shrunk log-odds of the label, by bucket.

        ``seen``: texts of label 0 and 1 with each bucket; ``n``: texts of either label.
        """
        odds = np.log((seen + 0.5) / (np.asarray(n)[:, None] + 1.0))
        self.words[:, 0] += (odds[1] - odds[0]) * seen.sum(0) / (seen.sum(0) + SHRINK) / VIEWS

    def dense(self):
        """All parameters but the words."""
        return [*self.filters.values(), self.bias, self.out]

    def rows(self):
        """All parameters as rows of ``DIM``: the words, then the others in turn, filled up with zeros."""
        rest = np.concatenate([*(p.ravel() for p in self.dense()), [self.out_bias]])
        return np.concatenate([self.words, np.pad(rest, (0, -len(rest) % DIM)).reshape(-1, DIM)])

    def load(self, rows):
        """Take the parameters from ``rows``."""
        self.words = rows[:BUCKETS].copy()
        rest, at = rows[BUCKETS:].ravel(), 0
        for p in self.dense():
            p[:] = rest[at:at + p.size].reshape(p.shape)
            at += p.size
        self.out_bias = float(rest[at])
        return self

    def fit(self, texts, labels, rng, passes):
        """AdaGrad over the texts, given as buckets by view and token, with labels 0 and 1."""
        labels = np.asarray(labels)
        params = [self.words, *self.dense()]
        speed = [np.full(p.shape, 1e-3) for p in params]
        bias_speed = 1e-3
        sizes = np.array([t.shape[1] for t in texts])
        for _ in range(passes):
            order = rng.permutation(len(texts))
            for batch in _steps(order, sizes):
                grads, db = self._gradients([texts[i] for i in batch], labels[batch])
                bias_speed += db * db
                self.out_bias -= RATE * db / np.sqrt(bias_speed)
                for p, s, g in zip(params, speed, grads):
                    if isinstance(g, tuple):
                        rows, g = g
                        s[rows] += g * g
                        p[rows] -= RATE * g / np.sqrt(s[rows])
                    else:
                        s += g * g
                        p -= RATE * g / np.sqrt(s)

    def _gradients(self, texts, labels):
        ids = np.concatenate(texts, axis=1)
        sizes = np.array([t.shape[1] for t in texts])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        x = self.words[ids[0]]
        for view in ids[1:]:
            x += self.words[view]
        left = np.repeat(starts + sizes, sizes) - np.arange(len(x))
        n = len(texts)
        pooled, arg = np.zeros((n, len(WIDTHS), FILTERS)), np.zeros((n, len(WIDTHS), FILTERS), int)
        for k, w in enumerate(WIDTHS):
            s = sum(_shifted(x, j, left) @ self.filters[w][j] for j in range(w)) if len(x) else np.zeros((0, FILTERS))
            for d in np.flatnonzero(sizes):
                part = s[starts[d]:starts[d] + sizes[d]]
                a = part.argmax(0)
                pooled[d, k], arg[d, k] = part[a, np.arange(FILTERS)], starts[d] + a
        act = pooled + self.bias
        on = (act > 0) & (sizes > 0)[:, None, None]
        z = (np.where(on, act, 0) * self.out).sum((1, 2)) + self.out_bias
        err = (1 / (1 + np.exp(-z)) - labels) / n
        d_out = (err[:, None, None] * np.where(on, act, 0)).sum(0) + 1e-5 * self.out
        d_act = np.where(on, err[:, None, None] * self.out, 0)
        d_filters, rows, d_rows = [], [], []
        for k, w in enumerate(WIDTHS):
            df = np.zeros_like(self.filters[w])
            for j in range(w):
                for f in range(FILTERS):
                    d = np.flatnonzero(on[:, k, f])
                    i = arg[d, k, f]
                    ok = left[i] > j if len(i) else np.zeros(0, bool)
                    d, i = d[ok], i[ok] + j
                    g = d_act[d, k, f][:, None]
                    df[j, :, f] += (g * x[i]).sum(0)
                    rows.append(i)
                    d_rows.append(g * self.filters[w][j, :, f])
            d_filters.append(df)
        at, g = np.concatenate(rows), np.concatenate(d_rows)

        u, inv = np.unique(ids[:, at], return_inverse=True)
        d_words = np.zeros((len(u), DIM))
        np.add.at(d_words, inv.ravel(), np.tile(g, (VIEWS, 1)))
        return [(u, d_words), *d_filters, d_act.sum(0), d_out], err.sum()

    def tables(self):
        """What scoring needs: each bucket's part of every filter position, and the last layer."""
        flat = np.concatenate([self.filters[w][j] for w in WIDTHS for j in range(w)], axis=1)
        return {"words": (self.words @ flat).astype(np.float32), "bias": self.bias, "out": self.out, "out_bias": float(self.out_bias)}


def scores(tables, first, ids):
    """Score of each text, in 0..1, from its token ids; a text without tokens gets the unit's bias alone."""
    sizes = np.diff(first)
    z = np.full(len(sizes), tables["out_bias"])
    some = np.flatnonzero(sizes)
    if len(some):
        parts = tables["words"][ids[0]]
        for view in ids[1:]:
            parts += tables["words"][view]
        left = np.repeat(first[1:], sizes) - np.arange(ids.shape[1])
        col = 0
        for k, w in enumerate(WIDTHS):
            s = parts[:, col:col + FILTERS].copy()
            for j in range(1, w):
                near = left[:-j] > j
                s[:-j][near] += parts[j:, col + j * FILTERS:col + (j + 1) * FILTERS][near]
            col += w * FILTERS
            top = np.maximum.reduceat(s, first[:-1][some], axis=0)
            z[some] += (np.maximum(top + tables["bias"][k], 0) * tables["out"][k]).sum(1)
    return 1 / (1 + np.exp(-z))


def _texts(hasher, batch):
    """Buckets by view and token of each whole text of a batch."""
    data, offsets = buffers(batch.column("text"))
    for i, j in slices(offsets):
        first, ids = token_ids(hasher, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
        ids = ids.astype(np.uint16)
        for a, b in zip(first, first[1:]):
            yield ids[:, a:b].copy()


def _count_texts(batches):
    """(at, n0, n1): texts of label 0 and 1 that hold each bucket, added up within the task."""
    import pyarrow as pa

    hasher, seen = Hasher(), np.zeros((2, BUCKETS), np.int64)
    for b in batches:
        for y, t in zip(b.column("y").to_pylist(), _texts(hasher, b)):
            seen[y, np.unique(t)] += 1
    at = np.flatnonzero(seen.any(0))
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen[0, at]), pa.array(seen[1, at])], names=["at", "n0", "n1"])


def _parts(batches):
    """(texts, labels) of rows in turn, ``PART_BYTES`` of text or a little more at a time."""
    hasher, texts, labels, size = Hasher(), [], [], 0
    for b in batches:
        labels += b.column("y").to_pylist()
        texts += _texts(hasher, b)
        size += b.column("text").nbytes
        if size >= PART_BYTES:
            yield texts, labels
            texts, labels, size = [], [], 0
    if texts:
        yield texts, labels


def _taught(model, passes):
    """(at, n, d0...): changes of the model's rows by learning, times the texts learnt from, added up within the task.

    Every part starts from the same model. A row of the words counts only for the parts that changed it.
    """
    def run(batches):
        import pyarrow as pa

        total = np.zeros((len(model.value), DIM + 1), np.int64)
        for texts, labels in _parts(batches):
            net = Network().load(model.value)
            net.fit(texts, labels, np.random.default_rng(7), passes)
            change = np.rint((net.rows() - model.value) / UNIT).astype(np.int64)
            moved = change.any(1)
            moved[BUCKETS:] = True
            total[moved, 0] += len(texts)
            total[moved, 1:] += change[moved] * len(texts)
        at = np.flatnonzero(total[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *(pa.array(c) for c in total[at].T.copy())], names=["at", *CHANGES])
    return run


CHANGES = ["n", *(f"d{i}" for i in range(DIM))]


def _summed(df: DataFrame, names: list) -> tuple:
    """(at, sums) of whole numbers by ``at``, of which there are as many as the model has rows, whatever the data."""
    found = df.groupBy("at").agg(*(F.sum(c).alias(c) for c in names)).toArrow()
    return found["at"].to_numpy(), np.stack([found[c].to_numpy() for c in names], axis=1)


def _scored(tables):
    def run(batches):
        import pyarrow as pa

        hasher, model = Hasher(), tables.value
        for b in batches:
            data, offsets = buffers(b.column("text"))
            out = np.zeros(len(offsets) - 1)
            for i, j in slices(offsets):
                part = data[offsets[i]:offsets[j]]
                out[i:j] = scores(model, *token_ids(hasher, part, offsets[i:j + 1] - offsets[i]))
            names = [n for n in b.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(out)], names=[*names, "score"])
    return run


GRID = np.linspace(0.05, 0.95, 91)


def _binned(tables):
    """(lang, y, at): how many of the cuts of the grid each score reaches."""
    def run(batches):
        import pyarrow as pa

        for b in _scored(tables)(batches):
            at = np.searchsorted(GRID, b.column("score").to_numpy(), side="right")
            yield pa.RecordBatch.from_arrays([b.column("lang"), b.column("y"), pa.array(at.astype(np.int32))], names=["lang", "y", "at"])
    return run


def best_cut(counts):
    """The cut with the best balanced accuracy, the middle one of several; None with fewer than 10 rows of a label.

    ``counts``: rows of label 0 and 1 by the number of cuts their score reaches.
    """
    if counts.sum(1).min() < 10:
        return None
    below, above = np.cumsum(counts[0]) / counts[0].sum(), 1 - np.cumsum(counts[1]) / counts[1].sum()
    hit = (below + above)[:-1]
    return float(np.median(GRID[hit >= hit.max() - 1e-9]))


def thresholds(binned: DataFrame) -> dict:
    """The best cut of each language, from (lang, y, at) of every row kept for it.

    Languages with fewer than 10 rows of either label take the cut over all languages,
    and ``DEFAULT_THRESHOLD`` holds where there are too few altogether. Key None: any other language.
    """
    def table(rows):
        counts = np.zeros((2, len(GRID) + 1))
        for r in rows:
            counts[r.y, r["at"]] += r.n
        return counts

    binned = stored(binned.groupBy("lang", "y", "at").agg(F.count(F.lit(1)).alias("n")), "toxicity-cuts")
    every = best_cut(table(binned.groupBy("y", "at").agg(F.sum("n").alias("n")).collect()))
    out = {None: DEFAULT_THRESHOLD if every is None else every}
    enough = binned.groupBy("lang").agg(*(F.sum(F.when(F.col("y") == y, F.col("n"))).alias(f"n{y}") for y in (0, 1)))
    own = {}
    for r in binned.join(enough.filter("lang is not null and n0 >= 10 and n1 >= 10").select("lang"), "lang").collect():
        own.setdefault(r.lang, []).append(r)
    return {**out, **{lang: best_cut(table(own[lang])) for lang in sorted(own)}}


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", lang_col: str = "lang", rows: int | None = TRAIN_ROWS):
    """(tables of the network, thresholds by language), learnt from every labelled row, whole texts, in tasks.

    The bias is set so that the best cut over all languages lies at ``DEFAULT_THRESHOLD``.
    All ``usable`` labelled ids count, one text (the lowest hash) for an id that repeats. Ids labelled both ways, and
    labels other than 0 and 1, are not used. About every fifth id, by hash, only calibrates the thresholds: scores of
    all of them are counted by language, label and cut. From the others, the texts that hold each bucket are counted;
    then each part of ``PART_BYTES`` of text is learnt from by one task, and the parts' changes are averaged,
    ``ROUNDS`` times. Rows that fit one part are gone through ``EPOCHS`` times (under 2,000 texts up to 20 times)
    by it alone. Without rows of both labels the network stays untrained, with a score below every
    threshold. Only sums of the size of the model reach the driver, whatever the number of rows.
    """
    lessons = stored(sample(docs, labels, usable, id_col, text_col, label_col, lang_col, rows), "toxicity-lessons")
    found = {r.y: (r.n, r.size) for r in lessons.filter("not held").groupBy("y").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("size")).collect()}
    net = Network()
    if len(found) < 2:
        net.out_bias = -6.0
        net.out[:] = 0
        return net.tables(), {None: DEFAULT_THRESHOLD}
    n, size = (sum(f[i] or 0 for f in found.values()) for i in (0, 1))
    parts = max(1, -(-size // PART_BYTES))
    pupils = lessons.filter("not held").select("y", "text").coalesce(parts)
    at, counts = _summed(pupils.mapInArrow(_count_texts, "at int, n0 long, n1 long"), ["n0", "n1"])
    seen = np.zeros((2, BUCKETS))
    seen[:, at] = counts.T
    net.start_from_counts(seen, [found[0][0], found[1][0]])
    rounds, passes = (ROUNDS, 1) if parts > 1 else (1, max(EPOCHS, min(20, 12_000 // n)) if n < 2000 else EPOCHS)
    context, schema = docs.sparkSession.sparkContext, ", ".join(["at int", *(f"{c} long" for c in CHANGES)])
    for _ in range(rounds):
        model = net.rows()
        at, sums = _summed(pupils.mapInArrow(_taught(context.broadcast(model), passes), schema), CHANGES)
        model[at] += sums[:, 1:] / sums[:, :1] * UNIT
        net.load(model)
    tables = net.tables()
    cuts = thresholds(lessons.filter("held").select("y", "lang", "text").mapInArrow(_binned(context.broadcast(tables)), "lang string, y int, at int"))
    shift = _logit(DEFAULT_THRESHOLD) - _logit(cuts[None])
    tables["out_bias"] += shift
    return tables, {k: float(1 / (1 + np.exp(-_logit(t) - shift))) for k, t in cuts.items()}


def sample(docs, labels, usable, id_col, text_col, label_col, lang_col, rows=TRAIN_ROWS) -> DataFrame:
    """(y, lang, text, held) of the rows that ``train`` learns from: all of them, unless ``rows`` (a label) is set.

    ``held``: the row only calibrates the thresholds.
    """
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
    known = known.filter(usable) if usable is not None else known
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("y"), F.max(label_col).alias("y2"))
    known = known.filter("y = y2").select("id", F.col("y").cast("int").alias("y"), F.xxhash64("id").alias("h"))
    if rows is not None:
        zero, one = (known.filter(F.col("y") == y).orderBy("h", "id").limit(rows) for y in (0, 1))
        known = zero.unionByName(one)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                        F.col(lang_col).cast("string").alias("lang"))
    texts = texts.filter("text is not null").join(sided(stored(known, "toxicity-labels")), "id")
    texts = texts.groupBy("id", "h").agg(F.min_by(F.struct("y", "lang", "text"), F.struct(F.xxhash64("text"), "lang")).alias("r"))
    held = F.pmod(F.xxhash64(F.lit("held"), "id"), F.lit(5)) == 0
    return texts.sortWithinPartitions("h", "id").select("r.*", held.alias("held"))


def _logit(p):
    return np.log(p / (1 - p))


def score(docs: DataFrame, labels: DataFrame, usable: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", lang_col: str = "lang", keep: tuple = ()) -> DataFrame:
    """Score every whole text for toxicity.

    The score depends on the text alone. Returns id, the columns named in ``keep`` (names other than the
    following), ``score``
    (0 to 1), ``threshold`` (calibrated for the row's language) and ``rejected`` (score at or
    above it). Null or empty texts, and texts without a word, get the score of no evidence.
    Rows that repeat are scored each; null ids are kept; an empty table gives no rows.
    """
    model = train(docs, labels, usable, id_col, text_col, label_col, lang_col)
    columns = list(dict.fromkeys([id_col, *keep]))
    names = [f"k{i}" for i in range(len(columns))]
    rows = docs.select(*(F.col(c).alias(n) for c, n in zip(columns, names)), F.col(lang_col).cast("string").alias("lang"),
                       F.col(text_col).cast("string").alias("text"))
    return _judged(rows, *model).select(*(F.col(n).alias(c) for c, n in zip(columns, names)), "score", "threshold", "rejected")


def clean_rows(docs: DataFrame, labels: DataFrame, usable: Column | None = None, id_col: str = "doc_id",
               text_col: str = "text", label_col: str = "toxic", lang_col: str = "lang") -> DataFrame:
    """``docs`` without the rows that ``score`` rejects; all columns stay, and no row moves."""
    model = train(docs, labels, usable, id_col, text_col, label_col, lang_col)
    rows = docs.select(whole_row(docs).alias("row"), F.col(lang_col).cast("string").alias("lang"),
                       F.col(text_col).cast("string").alias("text"))
    return _judged(rows, *model).filter("not rejected").select("row.*")


def _judged(rows: DataFrame, tables: dict, cuts: dict) -> DataFrame:
    """``rows`` (with ``lang`` and ``text``) without the text, and with score, threshold and decision."""
    schema = T.StructType([f for f in rows.schema if f.name != "text"]).add("score", "double")
    cut = F.lit(cuts[None])
    for lang, t in cuts.items():
        if lang is not None:
            cut = F.when(F.col("lang") == lang, F.lit(t)).otherwise(cut)
    out = rows.mapInArrow(_scored(rows.sparkSession.sparkContext.broadcast(tables)), schema)
    return out.withColumn("threshold", cut).withColumn("rejected", F.col("score") >= F.col("threshold"))
