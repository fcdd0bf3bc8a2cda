"""Repeated passages by a run-length compressed Burrows-Wheeler index."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .counters import PIECES, merged, packed
from .store import dropped, sided, stored
from .textbytes import Hasher, buffers, mix, slices

#: Bytes of an anchor. Every string of ``length`` bytes has one: its anchor of least hash.
ANCHOR = 64
#: Anchors are compared by so many bits, then by place (28 bits: the bytes of a slice).
PLACE_BITS = 28
#: Stretches of a reduce group, and bytes of an index.
GROUP_STRETCHES, INDEX_BYTES = 200_000, 1 << 20
#: Keys of texts to be read again are broadcast up to this number, and joined by key beyond.
BROADCAST_KEYS = 500_000
#: Anchors are counted in a fixed table (4 MB). One with so many more stretches than twice the usual count would make
#: a task's group or index grow with the data, so its strings of ``length`` bytes are counted one by one instead.
COUNTERS, HOT_STRETCHES = 1 << 20, 20_000


def sliding_least(v: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbouring values, by doubling."""
    done, out = 1, v
    while done * 2 <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    if done < width:
        out = np.minimum(out[:len(v) - width + 1], out[width - done:])
    return out


def stretches(hasher, data, offsets, length):
    """(text, start, end, anchor hash, digest) of the stretches of a slice.

    A stretch holds the neighbouring ``length``-byte strings of a text that have their anchor at the same
    place. The anchor depends on the string alone, so equal strings lie in stretches with equal anchors.
    """
    n = len(data)
    if n < length:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64))
    prefix = hasher.prefix(data)
    at = np.arange(n - ANCHOR + 1)
    anchors = hasher.spans(prefix, at, at + ANCHOR)
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = sliding_least((anchors & ~low) | at.astype(np.uint64), length - ANCHOR + 1)
    place = (least & low).astype(np.int64)
    edge = np.zeros(n + 1, np.int64)
    long_ = np.flatnonzero(np.diff(offsets) >= length)
    edge[offsets[long_]] += 1
    edge[offsets[long_ + 1] - length + 1] -= 1
    valid = np.cumsum(edge)[:len(place)] > 0
    start = valid.copy()
    start[1:] &= ~valid[:-1] | (place[1:] != place[:-1])
    if len(long_):
        start[offsets[long_]] = True
    first = np.flatnonzero(start)
    stop = valid.copy()
    stop[:-1] &= ~valid[1:] | start[1:]
    end = np.flatnonzero(stop) + length
    text = np.searchsorted(offsets, first, side="right") - 1
    return text, first - offsets[text], end - offsets[text], anchors[place[first]], hasher.spans(prefix, first, end)


PACKED = ("anchor", "key", "start", "size", "digest")
KINDS = (np.int64, np.int64, np.uint32, np.uint16, np.int64)


def _stretches(length, parts):
    """The stretches of every distinct text of a task, packed by part (a hash of the anchor)."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        hasher, kept, size, seen, counts = Hasher(), [], 0, set(), np.zeros(COUNTERS, np.int64)

        def flushed():
            cols = [np.concatenate([k[i] for k in kept]) for i in range(5)]
            np.add(counts, np.bincount(_counter(cols[0]), minlength=COUNTERS), out=counts)
            part = (mix(cols[0].view(np.uint64)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            cuts = np.flatnonzero(np.diff(part[order], prepend=-1, append=-2))
            cols = [c[order] for c in cols]
            k = len(cuts) - 1
            return pa.RecordBatch.from_arrays(
                [pa.array(part[order[cuts[:-1]]]), *(pa.array([c[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()) for c in cols),
                 pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary())], names=["part", *PACKED, "piece", "task", "counts"])

        for b in batches:
            data, offsets = buffers(b.column("text"))
            keys = b.column("key").to_numpy(zero_copy_only=False)
            for i, j in slices(offsets):
                own = [d for d in range(i, j) if keys[d] not in seen]
                seen.update(keys[i:j].tolist())
                if not own:
                    continue
                part = data[offsets[i]:offsets[j]] if len(own) == j - i else np.concatenate([data[offsets[d]:offsets[d + 1]] for d in own])
                offs = np.concatenate([[0], np.cumsum([offsets[d + 1] - offsets[d] for d in own])]).astype(np.int64)
                text, start, end, anchor, digest = stretches(hasher, part, offs, length)
                kept.append((anchor.view(np.int64), keys[own][text], start.astype(np.uint32), (end - start).astype(np.uint16), digest.view(np.int64)))
                size += len(text)
            if len(seen) > 2_000_000:
                seen = set()
            if size >= 5 * GROUP_STRETCHES:
                yield flushed()
                kept, size = [], 0
        if size:
            yield flushed()
        if counts.any():
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(PIECES, pa.int64()), *(pa.nulls(PIECES, pa.binary()) for _ in PACKED), pa.array(range(PIECES), pa.int32()),
                 pa.array([task] * PIECES, pa.int64()), pa.array(packed(counts), pa.binary())], names=["part", *PACKED, "piece", "task", "counts"])
    return run


def _counter(anchor):
    return (mix(anchor.view(np.uint64)) & np.uint64(COUNTERS - 1)).astype(np.int64)


def _cold(counts, most):
    """Packed stretches without those of hot anchors."""
    def run(batches):
        import pyarrow as pa

        table = counts.value
        for b in batches:
            cols = [[np.frombuffer(x, t) for x in b.column(c).to_pylist()] for c, t in zip(PACKED, KINDS)]
            keep = [table[_counter(a)] <= most for a in cols[0]]
            yield pa.RecordBatch.from_arrays(
                [b.column("part"), *(pa.array([x[k].tobytes() for x, k in zip(c, keep)], pa.binary()) for c in cols)], names=["part", *PACKED])
    return run


def _hot(counts, most):
    """The stretches of hot anchors, one by one."""
    def run(batches):
        import pyarrow as pa

        table = counts.value
        for b in batches:
            cols = [np.concatenate([np.frombuffer(x, t) for x in b.column(c).to_pylist()] or [np.zeros(0, t)]) for c, t in zip(PACKED, KINDS)]
            hot = table[_counter(cols[0])] > most
            anchor, key, start, size, digest = (c[hot] for c in cols)
            start = start.astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (anchor, digest, key, start, start + size)],
                                             names=["anchor", "digest", "key", "start", "stop"])
    return run


def _hot_kinds(hot: DataFrame) -> DataFrame:
    """Stretches of hot anchors by kind: all of a class of equal ones repeat (kind 0); one of each class has its strings
    counted (kind 3: has no equal, 4: has). Classes are counted before anything is gathered."""
    each = stored(hot.distinct(), "rep-hot")
    place = F.struct("key", "start", "stop")
    classes = stored(each.groupBy("anchor", "digest").agg(F.count("*").alias("copies"), F.min(place).alias("one")), "rep-classes-hot")
    several = classes.filter("copies > 1").select(F.col("anchor").alias("a"), F.col("digest").alias("d"))
    whole = each.join(sided(several), (F.col("anchor") == F.col("a")) & (F.col("digest") == F.col("d")), "left_semi")
    whole = whole.select(F.lit(0).alias("kind"), "anchor", "key", "start", "stop")
    one = classes.select(F.when(F.col("copies") > 1, 4).otherwise(3).alias("kind"), "anchor", "one.key", "one.start", "one.stop")
    return whole.unionByName(one)


def _strings(length):
    """Hash and place of every ``length``-byte string of a stretch."""
    def run(batches):
        import pyarrow as pa

        hasher = Hasher()
        for b in batches:
            kinds, keys, places, hashes = [], [], [], []
            for kind, raw, key, start in zip(*(b.column(c).to_pylist() for c in ("kind", "bytes", "key", "start"))):
                at = np.arange(len(raw) - length + 1)
                kinds.append(np.full(len(at), kind, np.int64))
                hashes.append(hasher.spans(hasher.prefix(np.frombuffer(raw, np.uint8)), at, at + length).view(np.int64))
                places.append(at + start)
                keys.append(np.full(len(at), key, np.int64))
            cols = [np.concatenate(c or [np.zeros(0, np.int64)]) for c in (kinds, keys, places, hashes)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["kind", "key", "start", "string"])
    return run


def _meet(table):
    """Stretches of a part by anchor: those equal to another one repeat as a whole (kind 0); where an anchor has
    different stretches, one of each kind goes to the index (kind 1: has no equal, 2: has)."""
    import pyarrow as pa

    cols = [np.concatenate([np.frombuffer(x, t) for x in table.column(c).to_pylist()]) for c, t in zip(PACKED, KINDS)]
    order = np.lexsort((cols[2], cols[1], cols[4], cols[0]))
    anchor, key, start, size, digest = (c[order] for c in cols)
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (digest[1:] != digest[:-1]) | (key[1:] != key[:-1]) | (start[1:] != start[:-1])
    anchor, key, start, size, digest = (c[new] for c in (anchor, key, start, size, digest))
    fresh_anchor = np.ones(len(anchor), bool)
    fresh_anchor[1:] = anchor[1:] != anchor[:-1]
    fresh = fresh_anchor.copy()
    fresh[1:] |= digest[1:] != digest[:-1]
    group = np.cumsum(fresh) - 1
    copies = np.bincount(group, minlength=1)[group] if len(group) else group
    family = np.cumsum(fresh_anchor) - 1
    variants = np.bincount(family[fresh], minlength=1)[family] if len(group) else group
    whole, ask = copies > 1, fresh & (variants > 1)
    kind = np.concatenate([np.zeros(whole.sum(), np.int32), np.where(copies[ask] > 1, 2, 1).astype(np.int32)])
    both = np.concatenate([np.flatnonzero(whole), np.flatnonzero(ask)])
    return pa.table({"kind": kind, "anchor": anchor[both], "key": key[both], "start": start[both].astype(np.int64),
                     "stop": start[both].astype(np.int64) + size[both]})


def run_index(text: np.ndarray, ends: np.ndarray):
    """Suffix array, run ends of the Burrows-Wheeler transform and rank tables of strings in one array.

    ``text`` holds bytes + 1 and a 0 after each string (at ``ends``); the zeros count as different from each
    other, in their order. Returns (suffix array, is run head, is run tail, ranks by prefix length).
    """
    n = len(text)
    string = np.zeros(n, np.int64)
    string[ends[:-1] + 1] = 1
    left = ends[np.cumsum(string)] - np.arange(n)
    pad = np.concatenate([text.astype(np.uint64), np.zeros(8, np.uint64)])
    word = np.zeros(n, np.uint64)
    for i in range(7):
        word = word * np.uint64(257) + np.where(left >= i, pad[i:i + n], 0)
    ranks, h = {}, 7
    order = np.argsort(word, kind="stable")
    fresh = np.ones(n, bool)
    fresh[1:] = (word[order[1:]] != word[order[:-1]]) | (left[order[1:]] < 7)
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(fresh) - 1
    ranks[h] = rank
    while not fresh.all():
        key = rank * np.int64(n + 1) + np.where(left >= h, rank[np.minimum(np.arange(n) + h, n - 1)] + 1, 0)
        order = np.argsort(key, kind="stable")
        sorted_ = key[order]
        fresh[1:] = sorted_[1:] != sorted_[:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh) - 1
        h *= 2
        ranks[h] = rank
    before = text[order - 1]
    head = np.ones(n, bool)
    head[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)
    tail = np.ones(n, bool)
    tail[:-1] = head[1:]
    return order, head, tail, ranks


def common_prefix(text, ranks, a, b):
    """Length of the common prefix of suffixes ``a`` and ``b`` (arrays), by the rank tables."""
    out, n = np.zeros(len(a), np.int64), len(text)
    for h in sorted(ranks, reverse=True):
        i, j = np.minimum(a + out, n - 1), np.minimum(b + out, n - 1)
        out += np.where(ranks[h][i] == ranks[h][j], h, 0)
    for _ in range(6):
        i, j = np.minimum(a + out, n - 1), np.minimum(b + out, n - 1)
        out += (text[i] == text[j]) & (text[i] > 0)
    return out


def matching_statistics(text: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For every place, the longest string from there that also starts elsewhere.

    Neighbours in the suffix array match longest. Where the transform repeats its letter, the
    place's match is the one of the place before, less one letter; so only the ends of runs are sampled
    and compared, and the rest is streamed from left to right.
    """
    order, head, tail, ranks = run_index(text, ends)
    n, out = len(text), None
    place = np.arange(n)
    for sampled, rows in ((head, np.flatnonzero(head[1:]) + 1), (tail, np.flatnonzero(tail[:-1]))):
        near = order[rows - 1] if sampled is head else order[rows + 1]
        reach = place.copy()
        reach[order[rows]] += common_prefix(text, ranks, order[rows], near)
        reach = np.maximum.accumulate(reach) - place
        out = reach if out is None else np.maximum(out, reach)
    return out


def runs_of(mark: np.ndarray):
    """Starts and ends of the runs of True."""
    step = np.diff(np.concatenate([[0], mark.astype(np.int8), [0]]))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def _index(length):
    """Marks of one index: parts of its stretches without an equal that are covered by longer matches."""
    def run(table):
        import pyarrow as pa

        raw = table.column("bytes").to_pylist()
        kind, key, start = (table.column(c).to_numpy() for c in ("kind", "key", "start"))
        known: dict[bytes, int] = {}
        keep = []
        for i, r in enumerate(raw):
            if r not in known:
                known[r] = i
                keep.append(i)
        sizes = np.array([len(raw[i]) for i in keep])
        ends = np.cumsum(sizes + 1) - 1
        text = np.zeros(int(ends[-1]) + 1, np.uint16)
        inside = np.ones(len(text), bool)
        inside[ends] = False
        text[inside] = np.frombuffer(b"".join(raw[i] for i in keep), np.uint8).astype(np.uint16) + 1
        match = matching_statistics(text, ends) >= length
        a, b = runs_of(match)
        own = np.searchsorted(ends, a, side="left")
        base = np.concatenate([[0], ends[:-1] + 1])[own]
        at = np.array(keep)[own] if len(own) else np.zeros(0, int)
        only = kind[at] == 1
        at, a, b, base = at[only], a[only], b[only], base[only]
        return pa.table({"key": key[at], "start": start[at] + a - base, "stop": start[at] + b - base - 1 + length})
    return run


def _cut_out(batches):
    """The bytes of the stretches asked for."""
    import pyarrow as pa

    for b in batches:
        out = []
        for raw, key, asks in zip(b.column("text").to_pylist(), b.column("key").to_pylist(), b.column("asks").to_pylist()):
            out += [(a["anchor"], a["kind"], key, a["start"], raw[a["start"]:a["stop"]]) for a in asks]
        cols = list(zip(*out)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()),
             pa.array(cols[4], pa.binary())], names=["anchor", "kind", "key", "start", "bytes"])


def _removed(batches):
    """What is left of each text without its spans."""
    import pyarrow as pa

    for b in batches:
        out = []
        for raw, spans in zip(b.column("text").to_pylist(), b.column("spans").to_pylist()):
            mark = np.zeros(len(raw) + 1, np.int64)
            np.add.at(mark, [s["start"] for s in spans], 1)
            np.add.at(mark, [s["stop"] for s in spans], -1)
            gone = np.cumsum(mark)[:-1] > 0
            starts, _ = runs_of(gone)
            out.append((int(gone.sum()), len(starts), hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest()))
        cols = list(zip(*out)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())],
                                         names=["key", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bytes of every text covered by a ``length``-byte string that also starts anywhere else.

    1. Texts are cut into overlapping stretches around anchors (the least hashed 64 bytes of every
       ``length``-byte string), and stretches meet by anchor. Equal stretches repeat as a whole.
    2. Where an anchor has different stretches, they are indexed together: a suffix array per about
       1 MB of stretches gives the Burrows-Wheeler transform, kept as runs. Matches are compared at the
       ends of runs only and streamed along the text; places with matches of ``length`` are marked.
       An anchor with very many stretches (``HOT_STRETCHES``) is not gathered: equal ones are counted first, and the
       strings of one of each kind are counted by hash.
    3. Spans are joined with their texts and taken out.

    Equal strings have equal anchors, so every repeat is found, and all are decided on bytes (stretches and
    texts are told apart by 64-bit hashes). Equal texts of at least ``length`` bytes are removed wholly.

    Returns id, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept_sha256`` for every row. Null and
    empty texts have no bytes; texts under ``length`` bytes lose nothing; repeated rows are copies of each other; null
    ids are kept. An empty table gives no rows; further columns are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("key"))
    base = stored(rows.select("id", "key", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha")), "rep-base")
    long_rows = rows.filter(F.octet_length("text") >= length).select("key", F.col("text").cast("binary").alias("text"), "id")
    classes = stored(base.filter(F.col("n_bytes") >= length).groupBy("key").agg(
        F.count("*").alias("copies"), F.min("id").alias("first_id"), F.min("n_bytes").alias("n_bytes")), "rep-classes")
    total = classes.agg(F.sum("n_bytes")).first()[0] or 0
    parts = int(max(1, total * 2 / (length - ANCHOR + 2) // GROUP_STRETCHES + 1))
    kind = "part long, " + ", ".join(f"{c} binary" for c in PACKED)
    stretch = "kind int, anchor long, key long, start long, stop long"
    told = stored(long_rows.select("key", "text").mapInArrow(_stretches(length, parts), f"{kind}, piece int, task long, counts binary"), "rep-stretches")
    groups, tables = told.filter("piece is null").select("part", *PACKED), told.filter("piece is not null")
    tasks = tables.agg(F.max("task")).first()[0]
    counts = merged(tables, tasks + 1, COUNTERS) if tasks is not None else np.zeros(COUNTERS, np.uint32)
    most = HOT_STRETCHES + 2 * int(counts.sum(dtype=np.int64)) // COUNTERS
    hot = bool((counts > most).any())
    if hot:
        shared = docs.sparkSession.sparkContext.broadcast(counts)
        one_by_one = _hot_kinds(groups.mapInArrow(_hot(shared, most), "anchor long, digest long, key long, start long, stop long"))
        groups = groups.mapInArrow(_cold(shared, most), kind)
    met = groups.groupBy("part").applyInArrow(_meet, stretch)
    met = stored(met.unionByName(one_by_one) if hot else met, "rep-met")
    dropped(told)
    spans = met.filter("kind = 0").select("key", "start", "stop")
    size, asked = met.agg(F.sum(F.when(F.col("kind").isin(1, 2), F.col("stop") - F.col("start")).otherwise(0)), F.count_if(F.col("kind") > 0)).first()
    if asked:
        asks = (met.filter("kind > 0").groupBy("key").agg(F.collect_list(F.struct("anchor", "kind", "start", "stop")).alias("asks"))
                .join(classes.select("key", "first_id"), "key"))
        one = _texts(long_rows, stored(asks, "rep-asks"), ["key", "asks"], F.col("id").eqNullSafe(F.col("first_id")))
        indexes = size // INDEX_BYTES + 1
        found = one.mapInArrow(_cut_out, "anchor long, kind int, key long, start long, bytes binary")
        marks = (found.filter("kind < 3").withColumn("part", F.pmod(F.xxhash64("anchor"), F.lit(indexes))).groupBy("part")
                 .applyInArrow(_index(length), "key long, start long, stop long"))
        if hot:
            strings = stored(found.filter("kind >= 3").select("kind", "key", "start", "bytes")
                             .mapInArrow(_strings(length), "kind long, key long, start long, string long"), "rep-strings")
            often = strings.groupBy("string").agg(F.count("*").alias("c")).filter("c > 1").select("string")
            marks = marks.unionByName(strings.filter("kind = 3").join(often, "string", "left_semi")
                                      .select("key", "start", (F.col("start") + length).alias("stop")))
        spans = spans.unionByName(stored(marks, "rep-marks"))
    single = classes.filter("copies = 1").select("key")
    lists = stored(spans.join(single, "key", "left_semi").groupBy("key").agg(F.collect_list(F.struct("start", "stop")).alias("spans")), "rep-spans")
    done = _texts(long_rows, lists, ["key", "spans"], F.lit(True)).mapInArrow(
        _removed, "key long, n_removed long, n_spans long, kept_sha256 string")
    every = classes.filter("copies > 1").select("key", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
                                                F.sha2(F.lit(""), 256).alias("kept_sha256"))
    done = stored(done.unionByName(every), "rep-done")
    return base.join(done, "key", "left").select(
        F.col("id").alias(id_col), "n_bytes", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0).cast("long")).alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"))


def _texts(rows: DataFrame, wanted: DataFrame, columns: list, more) -> DataFrame:
    """The texts of the keys in ``wanted``, with its ``columns``; only those texts are shuffled."""
    keys = wanted.select("key")
    keys = F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys
    return rows.join(keys, "key", "left_semi").join(wanted, "key").filter(more).select("text", *columns)
