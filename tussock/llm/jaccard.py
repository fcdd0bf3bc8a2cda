"""N-gram Jaccard join with adaptive multi-match prefixes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .counters import PIECES, merged, packed
from .store import dropped, shared_folder, sided, stored, whole_row
from .textbytes import Hasher, buffers, mix, ngram_hashes, slices, word_hashes

#: Counters of the shingle frequencies (a fixed table, 4 MB).
COUNTERS = 1 << 20
#: Least and longest extension of a prefix: a pair must share as many prefix tokens. With two, one chance meeting isn't enough.
MIN_MATCHES, MAX_MATCHES = 2, 4
#: Checking a pair costs about as much as reading so many postings.
CHECK_COST = 20
#: Postings of a reduce group; tokens counted more often than this by the counters skip those groups.
GROUP_POSTINGS, HOT_TOKEN = 200_000, 20_000
#: Postings of a list compared with so many of its next larger ones before the list is passed on.
NEIGHBOURS = 32
#: Cells of a set's profile: how many of its shingles fall into each, up to 255.
PROFILE = 256
#: Ids of texts to be checked are broadcast up to this number, and joined by key beyond.
BROADCAST_IDS = 500_000
#: Rounds of links to one pivot a list before the remaining pairs are listed; more only while they pay.
PIVOT_ROUNDS = 6


def shingle_sets(hasher, data, offsets, n=5):
    """The sorted distinct ``n``-word shingle hashes of each text; a shorter text counts as one shingle."""
    first, w = word_hashes(hasher, data, offsets)
    grams = ngram_hashes(w, n)
    for a, b in zip(first, first[1:]):
        if b - a >= n:
            yield np.unique(grams[a:b - n + 1])
        elif b > a:
            yield mix(ngram_hashes(w[a:b], int(b - a)) + np.uint64(b - a))
        else:
            yield grams[:0]


def fingerprint(s: np.ndarray) -> int:
    """64 bits that stand for a whole set."""
    if not len(s):
        return 0
    m = mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    x = mix(np.array([np.bitwise_xor.reduce(m), m.sum(dtype=np.uint64), len(s)], np.uint64))
    return int((x * np.array([3, 5, 1], np.uint64)).sum(dtype=np.uint64).astype(np.int64))


def profile(s: np.ndarray) -> bytes:
    """Shingles of a set by cell of their hash; two sets share at most the sum of the smaller counts."""
    return np.minimum(np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=PROFILE), 255).astype(np.uint8).tobytes()


def least_overlap(n: int, percent: int) -> int:
    """Shingles that a set of n must share with any set linked to it."""
    return -(-percent * n // 100)


def prefix(s: np.ndarray, counts: np.ndarray, usual: float, percent: int):
    """(prefix tokens, matches asked for): the rarest tokens of a set, rarest first.

    A pair that must share ``need`` tokens shares at least m within the first n - need + m of
    each, and a set's own least overlap is the lowest ``need`` of its pairs. Longer prefixes read more
    postings and ask for more matches, so fewer pairs are checked; m is chosen by the estimated cost
    from the token counts above the usual ones.
    """
    n = len(s)
    seen = counts[s & np.uint64(COUNTERS - 1)]
    order = np.argsort(seen, kind="stable")
    over = least_overlap(n, percent)
    excess = np.cumsum(np.maximum(seen[order].astype(float) - usual, 0))
    m = np.arange(min(MIN_MATCHES, over), min(MAX_MATCHES, over) + 1)
    lists = excess[n - over + m - 1]
    m = int(m[np.argmin(lists + CHECK_COST * lists / m)])
    return s[order[:n - over + m]], m


def _survey(n):
    """Per document id, set size and fingerprint; per partition the shingle counters, in pieces."""
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        hasher, counts = Hasher(), np.zeros(COUNTERS, np.uint32)
        kind = None
        for b in batches:
            data, offsets = buffers(b.column("text"))
            kind = b.schema.field("id").type
            size, fp, cells = [], [], []
            for i, j in slices(offsets):
                sets = list(shingle_sets(hasher, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], n))
                size += [len(s) for s in sets]
                fp += [fingerprint(s) for s in sets]
                cells += [profile(s) for s in sets]
                counts += np.bincount((np.concatenate(sets) & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS).astype(np.uint32)
            k = len(size)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("key"), pa.array(size, pa.int64()), pa.array(fp, pa.int64()), pa.array(cells, pa.binary()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())],
                names=["id", "key", "n", "fp", "cells", "task", "piece", "counts"])
        if kind is not None:
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(PIECES, kind), pa.nulls(PIECES, pa.int64()), pa.nulls(PIECES, pa.int64()), pa.nulls(PIECES, pa.int64()), pa.nulls(PIECES, pa.binary()), pa.array([task] * PIECES, pa.int64()),
                 pa.array(range(PIECES), pa.int32()), pa.array(packed(counts), pa.binary())],
                names=["id", "key", "n", "fp", "cells", "task", "piece", "counts"])
    return run


def _prefixes(counts, usual, percent, n, parts, hot_ones):
    """Postings (token, set, matches) of the prefixes, packed by part; or those of tokens over HOT_TOKEN, one by one."""
    def run(batches):
        import pyarrow as pa

        hasher, table = Hasher(), counts.value
        kept, size, seen = [], 0, set()

        def postings():
            cols = [np.concatenate([k[i] for k in kept]) for i in range(len(PACKED))]
            tokens = cols[0]
            hot = table[tokens & np.uint64(COUNTERS - 1)] > HOT_TOKEN
            part = (mix(tokens) % np.uint64(parts)).astype(np.int64)
            rows = []
            if hot_ones:
                return pa.RecordBatch.from_arrays(
                    [pa.array(c[hot].astype(t)) for c, t in zip(cols, (np.int64, np.int64, np.int32, np.int32, np.int64))], names=["token", "fp", "m", "place", "n"])
            cold = np.flatnonzero(~hot)
            cold = cold[np.argsort(part[cold], kind="stable")]
            cuts = np.flatnonzero(np.diff(part[cold], prepend=-1, append=-2))
            for a, b in zip(cuts, cuts[1:]):
                at = cold[a:b]
                rows.append((int(part[at[0]]), *(c[at] for c in cols)))
            cols = list(zip(*rows)) or [[]] * (1 + len(PACKED))
            return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), *(pa.array([x.tobytes() for x in c], pa.binary()) for c in cols[1:])],
                                              names=["part", *PACKED])

        for b in batches:
            data, offsets = buffers(b.column("text"))
            for i, j in slices(offsets):
                for s in shingle_sets(hasher, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], n):
                    fp = fingerprint(s)
                    if not len(s) or fp in seen:
                        continue
                    seen.add(fp)
                    tokens, m = prefix(s, table, usual, percent)
                    kept.append((tokens, np.full(len(tokens), fp, np.int64), np.full(len(tokens), m, np.int8),
                                 np.arange(len(tokens), dtype=np.uint32), np.full(len(tokens), len(s), np.uint32)))
                    size += len(tokens)
                    if size >= 5 * GROUP_POSTINGS:
                        yield postings()
                        kept, size, seen = [], 0, set()
        if kept:
            yield postings()
    return run


PACKED = ("tokens", "fps", "ms", "places", "sizes")
KINDS = (np.int64, np.int64, np.int8, np.uint32, np.uint32)
POSTING = "token long, fp long, m int, place int, n long"


def _unpacked(table):
    return [np.concatenate([np.frombuffer(x, t) for x in table.column(c).to_pylist()] or [np.zeros(0, t)]) for c, t in zip(PACKED, KINDS)]


def fitting(tokens, ms, places, sizes, percent):
    """Which postings have a partner in their list that leaves room for a link, by sizes and places.

    Postings are in order of token and size. The partners whose sizes fit are neighbours; the next ``NEIGHBOURS`` ones
    are compared one by one, and a posting with more of them stays.
    """
    keep = np.zeros(len(tokens), bool)
    for d in range(1, NEIGHBOURS + 2):
        i = np.flatnonzero(tokens[d:] == tokens[:-d])
        j = i + d
        ok = 100 * sizes[i] >= percent * sizes[j]
        i, j = i[ok], j[ok]
        if not len(i):
            break
        if d <= NEIGHBOURS:
            need, asked = -(-percent * (sizes[i] + sizes[j]) // (100 + percent)), np.minimum(ms[i], ms[j])
            ok = (places[i] < sizes[i] - need + asked) & (places[j] < sizes[j] - need + asked)
            i, j = i[ok], j[ok]
        keep[i] = keep[j] = True
    return keep


def _shared(percent):
    """Of one part, the postings that have a fitting partner in their token's list."""
    def run(table):
        import pyarrow as pa

        tokens, fps, ms, places, sizes = _unpacked(table)
        order = np.lexsort((fps, sizes, tokens))
        tokens, fps = tokens[order], fps[order]
        new = np.ones(len(tokens), bool)
        new[1:] = (tokens[1:] != tokens[:-1]) | (fps[1:] != fps[:-1])
        order, tokens, fps = order[new], tokens[new], fps[new]
        same = tokens[1:] == tokens[:-1]
        keep = np.zeros(len(tokens), bool)
        keep[1:] |= same
        keep[:-1] |= same
        at, tokens, fps = order[keep], tokens[keep], fps[keep]
        ms, places, sizes = (x[at].astype(np.int64) for x in (ms, places, sizes))
        keep = fitting(tokens, ms, places, sizes, percent)
        return pa.table({"token": tokens[keep], "fp": fps[keep], "m": ms[keep].astype(np.int32), "place": places[keep].astype(np.int32), "n": sizes[keep]})
    return run


def _by_set(n):
    """(fingerprint of the set, text); of equal sets of a task, one."""
    def run(batches):
        import pyarrow as pa

        hasher, seen = Hasher(), set()
        for b in batches:
            data, offsets = buffers(b.column("text"))
            fps = []
            for i, j in slices(offsets):
                fps += [fingerprint(s) for s in shingle_sets(hasher, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], n)]
            keep = [k for k, fp in enumerate(fps) if not (fp in seen or seen.add(fp))]
            yield pa.RecordBatch.from_arrays([pa.array(fps, pa.int64()), b.column("text")], names=["fp", "text"]).take(pa.array(keep, pa.int64()))
    return run


def _possible(percent):
    """The pairs whose profiles leave room for enough shared shingles; full cells leave any room."""
    def run(batches):
        import pyarrow as pa

        for b in batches:
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint8).reshape(-1, PROFILE) for c in ("x", "y"))
            full = ((x == 255) & (y == 255)).any(1)
            both = np.minimum(x, y).sum(1, dtype=np.int64)
            total = b.column("n").to_numpy(zero_copy_only=False) + b.column("n2").to_numpy(zero_copy_only=False)
            keep = full | (100 * both >= percent * (total - both))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(keep))
    return run


def _check(percent, n):
    """The pairs whose sets, made from the whole texts, reach the similarity."""
    def run(batches):
        import pyarrow as pa

        hasher, known = Hasher(), {}

        def shingles(key, column, i):
            if key not in known:
                if len(known) > 200:
                    known.clear()
                data, offsets = buffers(column.slice(i, 1))
                known[key] = next(shingle_sets(hasher, data, offsets, n))
            return known[key]

        for b in batches:
            ok = []
            for i, (k, l) in enumerate(zip(b.column("a").to_pylist(), b.column("b").to_pylist())):
                x, y = shingles(k, b.column("x"), i), shingles(l, b.column("y"), i)
                both = len(x) + len(y) - len(np.union1d(x, y))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return run


def near_duplicates(docs: DataFrame, percent: int = 80, n: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Components of documents whose shingle sets have a Jaccard similarity of ``percent`` or more.

    Words are ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; a set holds the distinct runs of ``n``
    words, or the whole sequence of a shorter text (as 64-bit hashes; equal sets are one node).

    1. One pass gives each set's size and fingerprint and counts all shingles in a fixed
       table of counters (4 MB), which orders shingles from rare to frequent.
    2. A second pass emits each set's prefix of n - overlap + m tokens; m grows with the
       estimated candidate cost, and a pair needs min(m, m') common prefix tokens. Postings meet by
       token; those of a single set are dropped.
    3. In every posting list the sets are checked against one pivot, exactly, and linked ones
       contracted. A large group of near copies so costs one check a member. Rounds go on while they pay.
       Before that, profiles (256 counts a set) rule out pairs that can't share enough.
    4. Pairs of a list that are still in different components are all checked, if they have
       enough common prefix tokens and fitting sizes. So no link between components is lost.

    Returns id, ``n_shingles``, ``component_id`` (smallest id of the component) and ``text_key`` (hash of the text) for every row.
    Null and empty texts have size 0 and are linked with nothing (their own id). Null ids take part and
    are never the smallest; a component of null ids only has null. Repeated rows are copies of
    each other. An empty table gives no rows; further columns are not read.
    """
    return _labelled(docs, percent, n, id_col, text_col).select(F.col("id").alias(id_col), "n_shingles", "component_id", "text_key")


def _labelled(docs, percent, n, id_col, text_col):
    """``near_duplicates`` with the id as ``id``, and the ``first`` row of the component (id and text hash; null for empty texts)."""
    spark = docs.sparkSession
    shared_folder(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    survey = stored(rows.withColumn("key", F.xxhash64("text")).mapInArrow(
        _survey(n), f"id {kind}, key long, n long, fp long, cells binary, task long, piece int, counts binary"), "nd-survey")
    base = survey.filter("piece is null").select("id", F.col("key").alias("text_key"), "n", "fp")
    tasks = survey.agg(F.max("task")).first()[0]
    total, postings = base.agg(F.sum("n"), F.sum(F.ceil(F.col("n") * (100 - percent) / 100) + 1)).first()
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first")
    sets = stored(survey.filter("piece is null and n > 0").groupBy("fp").agg(first, F.min("n").alias("n"), F.min("cells").alias("cells"))
                  .select("fp", "n", "cells", "first", F.col("first.id").alias("id")), "nd-sets")
    links = _all_links(rows, survey, sets, (tasks or 0) + 1, total or 0, postings or 0, percent, n) if total else None
    if links is None:
        merged = sets.select("fp", "first")
    else:
        # Only linked sets look up their component; a component's first row is carried to its sets.
        labels = connected_components(links).select(F.col("node").alias("l_fp"), "label")
        linked = stored(sets.select("fp", "first").join(sided(labels), F.col("fp") == F.col("l_fp")).select("fp", "label", "first"), "nd-linked")
        lead = stored(linked.groupBy("label").agg(F.min("first").alias("lead")), "nd-leads")
        moved = linked.join(sided(lead), "label").select(F.col("fp").alias("l_fp"), "lead")
        merged = sets.join(moved, F.col("fp") == F.col("l_fp"), "left").select("fp", F.coalesce("lead", "first").alias("first"))
    merged = stored(merged.select(F.col("fp").alias("m_fp"), "first"), "nd-components")
    dropped(sets)
    return (base.join(merged, (F.col("n") > 0) & (F.col("fp") == F.col("m_fp")), "left")
            .select("id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("first.id")).otherwise(F.col("id")).alias("component_id"),
                    "text_key", "first"))


def one_of_each(docs: DataFrame, percent: int = 80, n: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component of near duplicates: the one with the smallest id, nulls last (of
    several texts with that id, the one with the smallest hash; of equal rows, one).

    Empty texts are duplicates of empty texts with their id only; without an id they all stay.
    All columns are kept. What goes is looked up by id and text hash, broadcast if it is small.
    """
    found = stored(_labelled(docs, percent, n, id_col, text_col).select(
        F.col("id").alias("r_id"), F.col("text_key").alias("r_key"), "n_shingles", "first"), "nd-result")
    found = found.filter("n_shingles > 0 or r_id is not null")
    empty = found.filter("n_shingles = 0").select("r_id", "r_key").distinct()
    least = empty.groupBy(F.col("r_id").alias("e_id")).agg(F.min("r_key").alias("e_key"))
    empty = empty.join(least, F.col("r_id") == F.col("e_id")).filter("r_key != e_key").select("r_id", "r_key")
    other = ~(F.col("r_id").eqNullSafe(F.col("first.id")) & (F.col("r_key") == F.col("first.key")))
    spare = stored(found.filter("n_shingles > 0").filter(other).select("r_id", "r_key").unionByName(empty).distinct(), "nd-spare")
    again = stored(found.groupBy("r_id", "r_key").count().filter("count > 1").select("r_id", "r_key"), "nd-again")
    rows = docs.select(whole_row(docs).alias("row"), F.col(id_col).alias("id"), F.xxhash64(F.col(text_col).cast("string")).alias("key"))
    same = F.col("id").eqNullSafe(F.col("r_id")) & (F.col("key") == F.col("r_key"))
    rows = rows.join(sided(spare), same, "left_anti")
    if not again.isEmpty():
        once = rows.join(sided(again), same, "left_semi").dropDuplicates(["id", "key"])
        rows = rows.join(sided(again), same, "left_anti").unionByName(once)
    return rows.select("row.*")


def _all_links(rows, survey, sets, tasks, total, postings, percent, n):
    """Checked pairs (a, b) of sets that connect every component."""
    spark = rows.sparkSession
    counts = merged(survey.filter("piece is not null"), tasks, COUNTERS)
    parts = max(1, -(-postings // GROUP_POSTINGS))
    table = spark.sparkContext.broadcast(counts)

    def prefixes(hot_ones, schema):
        return rows.select("text").mapInArrow(_prefixes(table, total / COUNTERS, percent, n, parts, hot_ones), schema)

    # The postings go from the texts into the lists without being stored between; those of very frequent tokens, where
    # there are any, come from a pass of their own.
    lists = prefixes(False, "part long, " + ", ".join(f"{c} binary" for c in PACKED)).groupBy("part").applyInArrow(_shared(percent), POSTING)
    met = stored(lists.unionByName(prefixes(True, POSTING).distinct()) if (counts > HOT_TOKEN).any() else lists, "nd-met")
    # A set with fewer postings left than the matches it needs (two at least, for sets of two or more) has no partner.
    enough = met.groupBy("fp").agg(F.count("*").alias("c"), F.min("m").alias("least"), F.min("n").alias("n"))
    enough = stored(enough.filter(F.col("c") >= F.least("least", F.lit(MIN_MATCHES))).select("fp").join(sets.select("fp", "id"), "fp"), "nd-some")
    lists = stored(met.join(sided(enough), "fp"), "nd-lists")
    dropped(met, enough)
    # A linked pair shares ``need`` tokens, and so ``asked`` of them within the first n - need + asked of either set.
    need, asked = F.ceil(percent * (F.col("n") + F.col("n2")) / (100 + percent)), F.least("m", "m2")
    fits = ((F.col("label") != F.col("label2")) & (100 * F.least("n", "n2") >= percent * F.greatest("n", "n2"))
            & (F.col("place") < F.col("n") - need + asked) & (F.col("place2") < F.col("n2") - need + asked))
    links, labels, last, live = None, None, None, lists
    for turn in range(PIVOT_ROUNDS):
        # Lists that the last round left with one component are done with, as links only join components.
        own = live.withColumn("label", F.col("fp")) if labels is None else (
            live.drop("label").join(sided(labels.select(F.col("node").alias("fp"), "label")), "fp", "left")
            .withColumn("label", F.coalesce("label", "fp")))
        mixed = own.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi").select("token")
        before, live = live, stored(own.join(mixed, "token", "left_semi"), "nd-live")
        dropped(before)
        order = F.struct(F.col("id").isNull(), "id", "fp") if turn % 2 == 0 else F.struct(F.xxhash64("fp", F.lit(turn)), "fp")
        width = live.groupBy("token", "label").agg(F.count("*").alias("c")).groupBy("token").agg(
            F.sum("c").alias("t"), F.sum(F.col("c") * F.col("c")).alias("s"))
        pairs, size = width.agg(F.sum((F.col("t") * F.col("t") - F.col("s")) / 2), F.sum("t")).first()
        if not pairs or (turn and (pairs <= 2 * size or last is not None and pairs > 0.7 * last and turn >= 2)):
            break
        last = pairs
        pivots = live.groupBy("token").agg(F.min_by(F.struct("fp", "n", "m", "place", "label"), order).alias("p"))
        pivots = pivots.select("token", F.col("p.fp").alias("a"), *(F.col(f"p.{c}").alias(f"{c}2") for c in ("n", "m", "place", "label")))
        meet = live.join(pivots, "token").filter(fits).select("a", F.col("fp").alias("b"), asked.alias("asked"))
        found = _checked(rows, _often(meet), sets, percent, n)
        if links is None:
            links = found
        else:
            before, links = links, stored(links.unionByName(found), "nd-links")
            dropped(before, found)
        before, labels = labels, connected_components(links)
        if before is not None:
            dropped(before)
    if labels is not None:
        dropped(labels)
    if not pairs:
        dropped(live)
        return links
    x = live.select("token", F.col("fp").alias("a"), "n", "m", "place", "label")
    y = live.select("token", F.col("fp").alias("b"), *(F.col(c).alias(f"{c}2") for c in ("n", "m", "place", "label")))
    meet = x.join(y, (x["token"] == y["token"]) & (F.col("a") < F.col("b")) & fits)
    found = _checked(rows, _often(meet.select("a", "b", asked.alias("asked"))), sets, percent, n)
    dropped(live)
    return found if links is None else links.unionByName(found)


def _often(meet):
    """The pairs that meet as often as they have to."""
    return meet.groupBy("a", "b").agg(F.count("*").alias("common"), F.min("asked").alias("asked")).filter("common >= asked").select("a", "b")


def _checked(rows, pairs, sets, percent, n):
    """The pairs (a, b) whose sets reach the similarity: by their profiles first, then by their full sets."""
    x = sets.select(F.col("fp").alias("a"), "n", F.col("cells").alias("x"))
    y = sets.select(F.col("fp").alias("b"), F.col("n").alias("n2"), F.col("cells").alias("y"))
    met = stored(pairs, "nd-candidates")
    pairs = sided(met).join(x, "a").join(y, "b").select("a", "b", "n", "n2", "x", "y")
    pairs = stored(pairs.mapInArrow(_possible(percent), "a long, b long"), "nd-pairs")
    dropped(met)
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("fp")).distinct()
    ids = stored(wanted.join(sets, "fp").select("id"), "nd-ids")
    few = ids.count() <= BROADCAST_IDS
    some = ids.filter("id is not null").distinct()
    texts = rows.join(F.broadcast(some) if few else some, "id", "left_semi").select("text")
    texts = texts.unionByName(rows.filter("id is null").select("text"))
    texts = stored(texts.mapInArrow(_by_set(n), "fp long, text string"), "nd-texts")
    x = texts.select(F.col("fp").alias("a"), F.col("text").alias("x"))
    y = texts.select(F.col("fp").alias("b"), F.col("text").alias("y"))
    found = stored(sided(pairs).join(x, "a").join(y, "b").select("a", "b", "x", "y")
                   .mapInArrow(_check(percent, n), "a long, b long").distinct(), "nd-found")
    dropped(pairs, ids, texts)
    return found
