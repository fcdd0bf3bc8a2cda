"""Language-model scores from Brown class-based bigrams."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .counters import PIECES, merged, packed
from .store import dropped, stored
from .textbytes import Hasher, buffers, lower, slices, word_bounds

#: Types that exchange clustering puts into classes: the most frequent words, the endings of all others, the end mark.
TOP_WORDS, ENDINGS, ENDING_BYTES = 1247, 800, 3
TYPES = TOP_WORDS + ENDINGS + 1
END_TYPE = TYPES - 1
CLASSES, SWEEPS = 96, 5
#: Every other word that occurs so often gets a class of its own, in so many sweeps over the learning texts.
OWN_COUNT, WORD_SWEEPS = 10, 2
#: Counts a word has at most: each class after it, each class before it, itself after it.
SLOTS = 2 * CLASSES + 1
#: The most frequent words' counts and classes are broadcast; all others' are joined by key.
LEXICON = 400_000
#: Bits of the table that tells tasks which other words may have a class of their own; a full one costs time only.
OPEN_BITS = 1 << 24
#: Distinct words that a task holds before it passes their counts on.
FLUSH = 1_500_000
#: Bytes of coded words (four each) worked on at once; temporary arrays take some 50 times as much.
CODED_BYTES = 1 << 20
ADD = 0.1
PRIOR = 20.0


def tokens(hasher, data, offsets):
    """(first word of each text plus the total, word hashes, ending types) of whole texts."""
    starts, ends = word_bounds(data, offsets)
    first = np.searchsorted(starts, offsets, side="left")
    if not len(starts):
        return first, np.zeros(0, np.int64), np.zeros(0, np.int16)
    prefix = hasher.prefix(lower(data))
    words = hasher.spans(prefix, starts, ends).view(np.int64)
    tail = hasher.spans(prefix, np.maximum(starts, ends - ENDING_BYTES), ends)
    return first, words, (TOP_WORDS + (tail % np.uint64(ENDINGS))).astype(np.int16)


def _added(kept):
    """Sorted distinct keys of the (keys, counts) in ``kept``, each sorted by itself, and their summed counts."""
    keys, c = (np.concatenate([k[i] for k in kept]) for i in range(2))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
    return keys[first], np.add.reduceat(c[order], first) if len(first) else c


def _count_words(batches):
    """(word, ending, c): counts of the words of the learning texts, added up within the task."""
    import pyarrow as pa

    hasher, held, kept = Hasher(), 0, []

    def added():
        words, ends, c = (np.concatenate([k[i] for k in kept]) for i in range(3))
        order = np.argsort(words, kind="stable")
        words = words[order]
        first = np.flatnonzero(np.append(True, words[1:] != words[:-1])[:len(words)])
        return words[first], ends[order[first]], np.add.reduceat(c[order], first) if len(first) else c

    def rows(x):
        for i in range(0, len(x[0]), 200_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[0][i:i + 200_000]), pa.array(x[1][i:i + 200_000].astype(np.int32)),
                                              pa.array(x[2][i:i + 200_000])], names=["word", "ending", "c"])

    for b in batches:
        data, offsets = buffers(b.column("text"))
        for i, j in slices(offsets):
            _, words, ends = tokens(hasher, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            u, at, c = np.unique(words, return_index=True, return_counts=True)
            kept.append((u, ends[at], c))
            held += len(u)
            if held >= 2 * FLUSH:
                kept = [added()]
                held = len(kept[0][0])
                if held >= FLUSH:
                    yield from rows(kept[0])
                    kept, held = [], 0
    if kept:
        yield from rows(added())


def find(keys: np.ndarray, words: np.ndarray):
    """(place in the sorted keys, whether it is there) of each word."""
    at = np.searchsorted(keys, words)
    at[at == len(keys)] = 0
    return at, (keys[at] == words) if len(keys) else np.zeros(len(words), bool)


def sequence(first, types, end=END_TYPE):
    """Types of all texts in one row: an end mark before the first text and after each."""
    n = len(first) - 1
    out = np.full(len(types) + n + 1, end, np.int64)
    out[np.arange(len(types)) + 1 + np.repeat(np.arange(n), np.diff(first))] = types
    return out


def _coded(keys):
    """(row, id, learn, at, far): whole texts as codes of their words, with the hashes of those outside the lexicon.

    A code is the word's place in the sorted ``keys``, or -1 - its ending type. So a table of values by place,
    followed by those by ending type in reverse, is indexed by codes of either kind (``by_code``).
    """
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        def column(values, first):
            return pa.Array.from_buffers(pa.binary(), len(first) - 1, [None, pa.py_buffer((first * values.itemsize).astype(np.int32)), pa.py_buffer(values)])

        hasher, lexicon = Hasher(), keys.value
        at_row = TaskContext.get().partitionId() << 36
        for b in batches:
            data, offsets = buffers(b.column("text"))
            n = len(offsets) - 1
            codes, far, size, away = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]
            for i, j in slices(offsets):
                first, words, ending = tokens(hasher, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                at, known = find(lexicon, words)
                codes.append(np.where(known, at, -1 - ending.astype(np.int64)).astype(np.int32))
                far.append(words[~known])
                size.append(np.diff(first))
                away.append(np.diff(np.concatenate([[0], np.cumsum(~known)])[first]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(at_row, at_row + n)), b.column("id"), b.column("learn"),
                 *(column(np.concatenate(x), np.cumsum(np.concatenate(k))) for x, k in ((codes, size), (far, away)))],
                names=["row", "id", "learn", "at", "far"])
            at_row += n
    return run


def _decoded(batch):
    """(i, j, first word of each text plus the total, codes, hashes of the words outside the lexicon) of slices of coded texts.

    The hashes are in a row with a zero for every word of the lexicon.
    """
    data, offsets = buffers(batch.column("at"))
    others, starts = buffers(batch.column("far"))
    data, others = data.view(np.int32), others.view(np.int64)
    for i, j in slices(offsets, CODED_BYTES):
        codes = data[offsets[i] // 4:offsets[j] // 4]
        words = np.zeros(len(codes), np.int64)
        words[codes < 0] = others[starts[i] // 8:starts[j] // 8]
        yield i, j, (offsets[i:j + 1] - offsets[i]) // 4, codes, words


def by_code(places, endings):
    """Values of the lexicon's words and of all types as one table, indexed by codes."""
    return np.concatenate([places, endings[::-1]])


def _count_pairs(types):
    """Bigram counts of types within the task, as one fixed table."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        counts, some = np.zeros(TYPES * TYPES, np.int64), False
        for b in batches:
            some = True
            for _, _, first, codes, _ in _decoded(b):
                row = sequence(first, types.value[codes])
                counts += np.bincount(row[:-1] * TYPES + row[1:], minlength=TYPES * TYPES)
        if some:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(PIECES), pa.int32()), pa.array([TaskContext.get().partitionId()] * PIECES, pa.int64()),
                 pa.array(packed(counts), pa.binary())], names=["piece", "task", "counts"])
    return run


def _xlogx(x):
    return x * np.log(np.maximum(x, 1))


def exchange(pairs: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each type, by exchange clustering of a table of bigram counts.

    Types start in classes by frequency, in turn; the last one (the end mark) has class 0 to itself. Each
    sweep takes the types from frequent to rare out of their class and puts them where the
    likelihood of the class bigrams is highest, until nothing moves. Ties: lowest class.
    """
    pairs = pairs.astype(float)
    n = len(pairs)
    weight = pairs.sum(0) + pairs.sum(1)
    order = np.argsort(-weight[:-1], kind="stable")
    label = np.zeros(n, int)
    label[order] = 1 + np.arange(n - 1) % (classes - 1)
    member = np.zeros((n, classes))
    member[np.arange(n), label] = 1
    right, left = pairs @ member, member.T @ pairs
    table = member.T @ right
    diagonal = np.arange(classes)
    for _ in range(sweeps):
        moved = 0
        for w in order:
            if not weight[w]:
                continue
            old, own = label[w], pairs[w, w]
            r, l = right[w].copy(), left[:, w].copy()
            r[old] -= own
            l[old] -= own
            table[old] -= r
            table[:, old] -= l
            table[old, old] -= own
            before = _xlogx(table)
            rows, cols = _xlogx(table + r) - before, _xlogx(table + l[:, None]) - before
            gain = rows.sum(1) - rows[diagonal, diagonal] + cols.sum(0) - cols[diagonal, diagonal]
            cell = table[diagonal, diagonal]
            gain += _xlogx(cell + r + l + own) - _xlogx(cell)
            out, into = table.sum(1), table.sum(0)
            gain -= _xlogx(out + r.sum() + own) - _xlogx(out) + _xlogx(into + l.sum() + own) - _xlogx(into)
            gain[0] = -np.inf
            new = int(np.argmax(gain))
            table[new] += r
            table[:, new] += l
            table[new, new] += own
            if new != old:
                moved += 1
                label[w] = new
                right[:, old] -= pairs[:, w]
                right[:, new] += pairs[:, w]
                left[old] -= pairs[w]
                left[new] += pairs[w]
        if not moved:
            break
    return label


def _count_classes(model):
    """(cell, c): class bigrams of the learning texts, added up within the task."""
    def run(batches):
        import pyarrow as pa

        m, counts = model.value, np.zeros(CLASSES * CLASSES, np.int64)
        for b in batches:
            for _, _, first, codes, _ in _decoded(b):
                row = sequence(first, m["kinds"][codes], m["end"])
                counts += np.bincount(row[:-1] * CLASSES + row[1:], minlength=CLASSES * CLASSES)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(counts[at])], names=["cell", "c"])
    return run


def _count_neighbours(model):
    """(w, slot, c, old): counts of the classes around each word that may move, added up within the task."""
    def run(batches):
        import pyarrow as pa

        m, held, kept = model.value, 0, []

        def rows(x):
            for i in range(0, len(x[0]), 200_000):
                w, slot = np.divmod(x[0][i:i + 200_000], SLOTS)
                yield pa.RecordBatch.from_arrays([pa.array(w), pa.array(slot.astype(np.int16)), pa.array(x[1][i:i + 200_000]),
                                                  pa.array(m["kinds"][w].astype(np.int16))], names=["w", "slot", "c", "old"])

        for b in batches:
            for _, _, first, codes, _ in _decoded(b):
                kind = sequence(first, m["kinds"][codes], m["end"])
                w = sequence(first, np.where(m["free"][codes], codes, -1), -1)
                at = np.flatnonzero(w >= 0)
                if not len(at):
                    continue
                same = at[w[at] == w[at + 1]]
                u, c = np.unique(np.concatenate([w[at] * SLOTS + kind[at + 1], w[at] * SLOTS + CLASSES + kind[at - 1],
                                                 w[same] * SLOTS + 2 * CLASSES]), return_counts=True)
                kept.append((u, c))
                held += len(u)
                if held >= 2 * FLUSH:
                    kept = [_added(kept)]
                    held = len(kept[0][0])
                    if held >= FLUSH:
                        yield from rows(kept[0])
                        kept, held = [], 0
        if kept:
            yield from rows(_added(kept))
    return run


def best_classes(table: np.ndarray, old: np.ndarray, at: np.ndarray, slot: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Class where each word raises the likelihood most, by the step of ``exchange`` with all others in place.

    ``old`` are the words' classes; ``at`` (the word's place in ``old``), ``slot`` and ``c`` their neighbour counts.
    """
    n, k = len(old), len(table)
    every = np.arange(n)
    full = np.zeros((n, 2 * k + 1))
    full[at, slot] = c
    r, l, own = full[:, :k], full[:, k:2 * k], full[:, -1]
    r[every, old] -= own
    l[every, old] -= own
    gain = np.zeros((n, k))
    for mine, other, cells in ((r, l, table), (l, r, table.T)):
        w, near = np.nonzero(mine)
        add = mine[w, near]
        base = cells.T[near].copy()
        base[np.arange(len(w)), old[w]] -= add
        back = np.flatnonzero(near == old[w])
        base[back] -= other[w[back]]
        base[back, near[back]] -= own[w[back]]
        more = _xlogx(base + add[:, None]) - _xlogx(base)
        more[np.arange(len(w)), near] = 0
        if len(w):
            first = np.flatnonzero(np.diff(w, prepend=-1))
            gain[w[first]] += np.add.reduceat(more, first)
    cell = np.tile(np.diagonal(table), (n, 1))
    cell[every, old] -= r[every, old] + l[every, old] + own
    gain += _xlogx(cell + r + l + own[:, None]) - _xlogx(cell)
    for total, part in ((table.sum(1), r), (table.sum(0), l)):
        size = (part.sum(1) + own)[:, None]
        rest = np.tile(total, (n, 1))
        rest[every, old] -= size[:, 0]
        gain -= _xlogx(rest + size) - _xlogx(rest)
    gain[:, 0] = -np.inf
    return gain.argmax(1)


def _moved(model):
    """(w, class) of rows (w, slot, c, old) sorted by w; ``old`` is the class that w has so far."""
    def run(batches):
        import pyarrow as pa

        table, left = model.value, None

        def rows(w, slot, c, old):
            u, first, at = np.unique(w, return_index=True, return_inverse=True)
            for i in range(0, len(u), 256):
                a, b = np.searchsorted(at, [i, i + 256])
                new = best_classes(table, old[first[i:i + 256]].astype(int), at[a:b] - i, slot[a:b], c[a:b])
                yield pa.RecordBatch.from_arrays([pa.array(u[i:i + 256]), pa.array(new.astype(np.int16))], names=["w", "class"])

        for b in batches:
            part = [b.column(x).to_numpy(zero_copy_only=False) for x in ("w", "slot", "c", "old")]
            if not len(part[0]):
                continue
            part = part if left is None else [np.concatenate(p) for p in zip(left, part)]
            cut = np.searchsorted(part[0], part[0][-1])
            left = [p[cut:] for p in part]
            if cut:
                yield from rows(*(p[:cut] for p in part))
        if left is not None:
            yield from rows(*left)
    return run


def likelihood(table: np.ndarray) -> float:
    """What the class bigrams say about the texts, up to a constant of the words."""
    return float(_xlogx(table).sum() - _xlogx(table.sum(0)).sum() - _xlogx(table.sum(1)).sum())


def best_of(near: DataFrame, table: np.ndarray) -> DataFrame:
    """(w, class): the best class of each w of rows (w, slot, c, old), at most ``SLOTS`` a word once added up."""
    near = near.repartition("w").groupBy("w", "slot", "old").agg(F.sum("c").alias("c"))
    moved = _moved(near.sparkSession.sparkContext.broadcast(table))
    return stored(near.select("w", "slot", "c", "old").sortWithinPartitions("w").mapInArrow(moved, "w long, class short"), "lm-moved")


def word_classes(lessons: DataFrame, classes: np.ndarray, free: np.ndarray, label: np.ndarray, table: np.ndarray):
    """(class of each word of the lexicon, class bigrams) after distributed sweeps of the ``free`` words over coded texts.

    In a sweep every free word goes where the likelihood is highest while all others stay; the sweep with the highest
    likelihood is kept.
    """
    context = lessons.sparkSession.sparkContext
    best = likelihood(table), classes, table
    for _ in range(WORD_SWEEPS if free.any() else 0):
        m = context.broadcast({"kinds": by_code(classes, label).astype(np.uint8), "free": by_code(free, np.zeros(TYPES, bool)), "end": label[END_TYPE]})
        moved = best_of(lessons.mapInArrow(_count_neighbours(m), "w long, slot short, c long, old short"), table).toArrow()
        classes = classes.copy()
        classes[moved["w"].to_numpy()] = moved["class"].to_numpy()
        m = context.broadcast({"kinds": by_code(classes, label).astype(np.uint8), "end": label[END_TYPE]})
        table = np.zeros(CLASSES * CLASSES)
        for r in lessons.mapInArrow(_count_classes(m), "cell int, c long").groupBy("cell").agg(F.sum("c").alias("c")).collect():
            table[r.cell] = r.c
        table = table.reshape(CLASSES, CLASSES)
        now = likelihood(table)
        if now <= best[0]:
            break
        best = now, classes, table
    return best[1:]


def open_bits(words: DataFrame) -> np.ndarray:
    """A bit table of fixed size with the low bits of each word's hash."""
    at = F.col("word").bitwiseAND(F.lit(OPEN_BITS - 1))
    found = (words.select(F.shiftright(at, 6).alias("at"), F.expr("shiftleft(1L, cast(word & 63 AS int))").alias("bit"))
             .groupBy("at").agg(F.bit_or("bit").alias("bits")).toArrow())
    out = np.zeros(OPEN_BITS // 64, np.uint64)
    out[found["at"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def may_be_open(bits, words, known):
    """Whether each word may be an open one: not ``known``, and its bit is set."""
    at = words & (OPEN_BITS - 1)
    return ~known & ((bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


def distinct(*keys):
    """(place of one of each, how many) of equal entries."""
    order = np.lexsort(keys)
    new = np.ones(len(order), bool)
    for n, k in enumerate(keys):
        k = k[order]
        new[1:] = (new[1:] if n else False) | (k[1:] != k[:-1])
    at = np.flatnonzero(new)
    return order[at], np.diff(np.append(at, len(order)))


def open_bigrams(kind, word, free, owner=None):
    """Counts of the bigrams of a row of tokens with a side that may be open, told apart by ``owner`` of the place.

    Returns a list: owner (None without), and per side the word (0 where it can't be open), whether it may be open,
    and its class; last the counts.
    """
    at = np.flatnonzero(free[:-1] | free[1:])
    sides = [(np.where(free[p], word[p], 0), free[p], kind[p]) for p in (at, at + 1)]
    who = np.zeros(len(at), np.int64) if owner is None else owner(at)
    one, c = distinct(*sides[0], *sides[1], who)
    return [who[one], *(x[one] for s in sides for x in s), c]


def _side(word, free, kind):
    """Arrow columns of one side of ``open_bigrams``."""
    import pyarrow as pa

    return [pa.array(word, pa.int64(), mask=~free), pa.array(kind.astype(np.int32))]


def _count_open(model):
    """(lw, lc, rw, rc, c): bigrams of the learning texts with a word that may be open, added up within a slice."""
    def run(batches):
        import pyarrow as pa

        m = model.value
        for b in batches:
            for _, _, first, codes, words in _decoded(b):
                free = sequence(first, may_be_open(m["bits"], words, codes >= 0), 0).astype(bool)
                _, *sides, c = open_bigrams(sequence(first, m["kinds"][codes], m["end"]), sequence(first, words, 0), free)
                yield pa.RecordBatch.from_arrays([*_side(*sides[:3]), *_side(*sides[3:]), pa.array(c)], names=["lw", "lc", "rw", "rc", "c"])
    return run


def relabelled(bigrams: DataFrame, opened: DataFrame) -> DataFrame:
    """``bigrams`` with the classes ``opened`` (word, class) has of their words; sides without a word pass by the join."""
    for word, kind in (("lw", "lc"), ("rw", "rc")):
        found = opened.select(F.col("word").alias(word), F.col("class").cast("int").alias("found"))
        met = bigrams.filter(F.col(word).isNotNull()).join(found, word, "left")
        met = met.withColumn(kind, F.coalesce("found", kind)).drop("found")
        bigrams = bigrams.filter(F.col(word).isNull()).unionByName(met)
    return bigrams


def open_classes(lessons: DataFrame, free: DataFrame, classes: np.ndarray, label: np.ndarray, table: np.ndarray, bits: np.ndarray):
    """((word, class) of the ``free`` (word, ending) beyond the lexicon, class bigrams), never collected.

    Each goes where the likelihood is highest while all others stay, as in ``word_classes``; should that lower the
    likelihood, all keep the classes of their endings.
    """
    m = lessons.sparkSession.sparkContext.broadcast({"kinds": by_code(classes, label).astype(np.uint8), "end": label[END_TYPE], "bits": bits})
    bigrams = stored(lessons.mapInArrow(_count_open(m), "lw long, lc int, rw long, rc int, c long")
                     .groupBy("lw", "lc", "rw", "rc").agg(F.sum("c").alias("c")), "lm-open")
    left, right = bigrams.filter("lw is not null"), bigrams.filter("rw is not null")
    near = (left.select(F.col("lw").alias("w"), F.col("rc").alias("slot"), "c", F.col("lc").alias("old"))
            .unionByName(right.select(F.col("rw").alias("w"), (F.col("lc") + CLASSES).alias("slot"), "c", F.col("rc").alias("old")))
            .unionByName(left.filter("lw = rw").select(F.col("lw").alias("w"), F.lit(2 * CLASSES).alias("slot"), "c", F.col("lc").alias("old"))))
    near = near.join(free.select(F.col("word").alias("w")), "w", "left_semi")
    opened = best_of(near.select("w", F.col("slot").cast("short").alias("slot"), "c", F.col("old").cast("short").alias("old")), table)
    opened = opened.withColumnRenamed("w", "word")
    cell = F.col("lc") * CLASSES + F.col("rc")
    changes = relabelled(bigrams.withColumn("was", cell), opened)
    changes = changes.select(F.explode(F.array(F.struct(F.col("was").alias("cell"), (-F.col("c")).alias("c")),
                                               F.struct(cell.alias("cell"), F.col("c").alias("c")))).alias("x")).select("x.*")
    now = table.copy().ravel()
    for r in changes.groupBy("cell").agg(F.sum("c").alias("c")).collect():
        now[r.cell] += r.c
    now = now.reshape(table.shape)
    dropped(bigrams)
    return (opened, now) if likelihood(now) > likelihood(table) else (opened.filter(F.lit(False)), table)


def _score(model):
    """Per text: what the class transitions and the words of the lexicon give; rows to be joined for all other words.

    Those are one for each distinct word outside the lexicon, and one for each distinct bigram with a word whose
    class may be found only by a join.
    """
    def run(batches):
        import pyarrow as pa

        m = model.value
        kinds, base_of, score_of, transition, end_base = (m[x] for x in ("kinds", "base", "score", "transition", "end_base"))

        def sums(values, first):
            out, some = np.zeros(len(first) - 1), np.flatnonzero(np.diff(first))
            out[some] = np.add.reduceat(values, first[some], dtype=float) if len(some) else 0
            return out

        def numbers(k):
            return [pa.nulls(k, t) for t in (pa.int64(), pa.int64(), pa.float64(), pa.float64())]

        def sides(k):
            return [pa.nulls(k, t) for t in (pa.int64(), pa.int32()) * 2]

        for b in batches:
            k = b.num_rows
            rows = b.column("row").to_numpy()
            size, known, base, score = (np.zeros(k) for _ in range(4))
            far, crossed = [], []
            for i, j, first, codes, words in _decoded(b):
                there, kind = codes >= 0, kinds[codes]
                row = sequence(first, kind, m["end"])
                step = transition[row[:-1] * CLASSES + row[1:]]
                free = sequence(first, may_be_open(m["bits"], words, there), 0).astype(bool)
                step[free[:-1] | free[1:]] = 0
                starts = first + np.arange(j - i + 1)
                crossed.append(open_bigrams(row, sequence(first, words, 0), free,
                                            lambda p, a=starts, r=rows[i:j]: r[np.searchsorted(a, p, side="right") - 1]))
                size[i:j] = np.diff(first)
                known[i:j] = sums(there, first)
                base[i:j] = sums(base_of[codes], first) + end_base
                score[i:j] = sums(step, starts) + sums(score_of[codes], first)
                rest = np.flatnonzero(~there)
                if len(rest):
                    doc = np.repeat(rows[i:j], np.diff(first))[rest]
                    order = np.lexsort((words[rest], doc))
                    doc, word, cls = doc[order], words[rest][order], kind[rest][order]
                    new = np.ones(len(doc), bool)
                    new[1:] = (doc[1:] != doc[:-1]) | (word[1:] != word[:-1])
                    at = np.flatnonzero(new)
                    far.append((doc[at], word[at], cls[at], np.diff(np.append(at, len(doc)))))
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("id"), b.column("learn"), pa.array(size.astype(np.int64)), pa.array(known.astype(np.int64)),
                 pa.array(base), pa.array(score), *(pa.nulls(k, t) for t in (pa.int64(), pa.int32(), pa.int32())), *sides(k)], names=NAMES)
            for who, *both, c in crossed:
                k = len(who)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(who), pa.nulls(k, b.schema.field("id").type), pa.nulls(k, pa.bool_()), *numbers(k), pa.nulls(k, pa.int64()),
                     pa.nulls(k, pa.int32()), pa.array(c.astype(np.int32)), *_side(*both[:3]), *_side(*both[3:])], names=NAMES)
            if far:
                doc, word, cls, tf = (np.concatenate([f[x] for f in far]) for x in range(4))
                k = len(doc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc), pa.nulls(k, b.schema.field("id").type), pa.nulls(k, pa.bool_()), *numbers(k),
                     pa.array(word), pa.array(cls.astype(np.int32)), pa.array(tf.astype(np.int32)), *sides(k)], names=NAMES)
    return run


def _frequent(words: DataFrame, most: int):
    """(words above a count, all others): at most ``most`` qualify, as pandas (word, ending, c), frequent first."""
    level = F.floor(F.log2("c") * 16)
    cut = 0
    for r in sorted(words.groupBy(level.alias("at")).count().collect(), key=lambda r: -r["at"]):
        most -= r["count"]
        if most < 0:
            cut = r["at"] + 1
            break
    out = words.filter(level >= cut).toArrow().to_pandas()
    return out.sort_values(["c", "word"], ascending=[False, True], ignore_index=True), words.filter(level < cut)


NAMES = ["row", "id", "learn", "size", "known", "base", "score", "word", "class", "tf", "lw", "lc", "rw", "rc"]


def class_scores(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
                 lexicon: int | None = None, top_words: int = TOP_WORDS, own_count: int = OWN_COUNT) -> DataFrame:
    """log10 probability of every whole text under a class bigram model learnt from the ``learn`` rows.

    Words are ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; an end mark follows the last word.
    P(w | w') = P(class(w) | class(w')) * P(w | class(w)). Exchange clustering first puts the
    1,247 most frequent words, and all others by their last three bytes (800 hashed endings), into 96 classes, by
    a table of type bigrams of all learning texts (2,048 * 2,048, whatever the corpus). Every other word that occurs
    ``own_count`` (ten) times or more then moves to the best class for its own neighbours: those of the ``lexicon``
    (the 400,000 most frequent words) in distributed sweeps, their classes broadcast; the rest, however many, in one more
    sweep whose classes stay in a stored table. A bit table of fixed size (2 MB) tells tasks which words may be of the
    rest; what depends on their classes, bigrams included, is joined. Only rarer and unseen words keep the class of their ending.
    Transitions are smoothed towards the class's share; emissions add 0.1 to every count, with one more
    unseen word a class, so each class's words sum to one.

    All word counts are summed over all learning texts. The scoring pass has the lexicon's counts broadcast and
    passes every other word on, once a text, to a join with the full counts. The driver holds the lexicon
    (20 bytes a word) and tables of fixed size, whatever the corpus.

    Returns id, ``held_out`` (not learnt from), ``n_tokens`` (words and the end), ``n_known`` (tokens seen in learning),
    ``train_tokens``, ``base_score`` (unigrams, add 0.1) and ``score``. Null and empty texts are the end alone.
    A null ``learn`` counts as true. Repeated rows count and are scored each. An empty table gives no rows; with
    nothing to learn from, every word is unseen.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(learn, F.lit(True)).alias("learn"),
                       F.col(text_col).cast("string").alias("text"))
    lessons = rows.filter("learn").select("text")
    words = stored(lessons.mapInArrow(_count_words, "word long, ending int, c long")
                   .groupBy("word").agg(F.min("ending").alias("ending"), F.sum("c").alias("c")), "lm-words")
    n_docs = lessons.count()
    n, v = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    common, others = _frequent(words, LEXICON if lexicon is None else lexicon)
    common["rank"] = np.arange(len(common))
    top = min(top_words, len(common))
    common = common.sort_values("word")
    key, ending, c, rank = (common[x].to_numpy() for x in ("word", "ending", "c", "rank"))
    first = rank < top
    kind = rows.schema["id"].dataType.simpleString()
    coded = stored(rows.mapInArrow(_coded(spark.sparkContext.broadcast(key)), f"row long, id {kind}, learn boolean, at binary, far binary"), "lm-coded")
    lessons = coded.filter("learn").select("at", "far")
    types = by_code(np.where(first, rank, ending), np.arange(TYPES))
    parts = stored(lessons.mapInArrow(_count_pairs(spark.sparkContext.broadcast(types)), "piece int, task long, counts binary"), "lm-pairs")
    tasks = (parts.agg(F.max("task")).first()[0] or 0) + 1
    pairs = merged(parts, tasks, TYPES * TYPES).reshape(TYPES, TYPES)
    label = exchange(pairs)
    classes = label[np.where(first, rank, ending)].astype(np.uint8)
    member = np.zeros((TYPES, CLASSES))
    member[np.arange(TYPES), label] = 1
    classes, step = word_classes(lessons, classes, ~first & (c >= own_count), label, member.T @ pairs @ member)
    size, kinds = np.bincount(classes, c, CLASSES), np.bincount(classes, minlength=CLASSES).astype(float)
    free = others.filter(F.col("c") >= own_count)
    bits = open_bits(free)
    opened = spark.createDataFrame([], "word long, class short")
    if bits.any():
        opened, step = open_classes(lessons, free.select("word", "ending"), classes, label, step, bits)
    others = others.join(opened, "word", "left").groupBy("ending", "class").agg(F.sum("c").alias("c"), F.count("*").alias("v"))
    for r in others.collect():
        at = label[r.ending] if r["class"] is None else r["class"]
        size[at] += r.c
        kinds[at] += r.v
    room = np.log10(size + ADD * (kinds + 1))
    share = (step.sum(0) + 1) / (step.sum() + CLASSES)
    step = np.log10((step + PRIOR * share) / (step.sum(1, keepdims=True) + PRIOR))
    total, kinds_all = float(n + n_docs), float(v + (n_docs > 0))
    below = np.log10(total + ADD * (kinds_all + 1))
    none = np.zeros(TYPES)
    model = {"kinds": by_code(classes, label).astype(np.uint8), "end": label[END_TYPE], "bits": bits, "transition": step.ravel(),
             "base": by_code(np.log10(c + ADD) - below, none), "score": by_code(np.log10(c + ADD) - room[classes], none),
             "end_base": np.log10(n_docs + ADD) - below}
    scored = stored(coded.mapInArrow(_score(spark.sparkContext.broadcast(model)),
                                     f"row long, id {kind}, learn boolean, size long, known long, base double, score double, "
                                     "word long, class int, tf int, lw long, lc int, rw long, rc int"), "lm-scored")
    dropped(coded)
    room_of = F.element_at(F.array(*(F.lit(float(x)) for x in room)), F.coalesce("own", "class") + 1)
    steps = spark.createDataFrame([(i, j, float(step[i, j])) for i in range(CLASSES) for j in range(CLASSES)], "lc int, rc int, step double")
    crossed = (relabelled(scored.filter("lc is not null").select("row", "tf", "lw", "lc", "rw", "rc"), opened)
               .join(F.broadcast(steps), ["lc", "rc"]).groupBy("row").agg(F.sum(F.col("tf") * F.col("step")).alias("crossed")))
    log_c = F.log10(F.coalesce("c", F.lit(0)) + F.lit(ADD))
    far = (scored.filter("word is not null").select("row", "word", "class", "tf")
           .join(words.select("word", "c").join(opened.select("word", F.col("class").alias("own")), "word", "left"), "word", "left")
           .groupBy("row").agg(F.sum(F.col("tf") * (log_c - F.lit(float(below)))).alias("far_base"),
                               F.sum(F.col("tf") * (log_c - room_of)).alias("far_score"),
                               F.sum(F.when(F.col("c").isNotNull(), F.col("tf")).otherwise(0)).alias("far_known")))
    zero = F.lit(0)
    return (scored.filter("size is not null").join(far, "row", "left").join(crossed, "row", "left")
            .select(F.col("id").alias(id_col), (~F.col("learn")).alias("held_out"), (F.col("size") + 1).alias("n_tokens"),
                    (F.col("known") + F.coalesce("far_known", zero) + F.lit(int(n_docs > 0))).cast("long").alias("n_known"),
                    F.lit(int(n + n_docs)).cast("long").alias("train_tokens"),
                    (F.col("base") + F.coalesce("far_base", F.lit(0.0))).alias("base_score"),
                    (F.col("score") + F.coalesce("far_score", F.lit(0.0)) + F.coalesce("crossed", F.lit(0.0))).alias("score")))
