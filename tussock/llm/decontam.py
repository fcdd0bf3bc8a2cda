"""Benchmark decontamination by pigeonhole edit matching."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType

from .textbytes import Hasher, buffers, letter_bounds, lower, slices

#: Word edits allowed in a passage, as a share of its words.
ERROR_RATE = 0.15
#: Items of fewer words must match without edits, and have so many bytes of words (four characters of Chinese) to tell a leak from chance.
MIN_WORDS, MIN_BYTES = 6, 12
#: First and last characters of scripts without spaces (Thai to Lao, Myanmar, Khmer, kana, Chinese), and of their punctuation.
UNSPACED = ((0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))
STOPS = ((0x3000, 0x303F), (0x30FB, 0x30FB), (0xFF00, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65))
#: The benchmark is worked off in chunks of about so many bytes, each broadcast in one pass over the documents.
CHUNK_BYTES = 8 << 20


def bounds(data, offsets):
    """Starts and ends of the words: runs of letters and digits, but single characters in scripts without spaces."""
    starts, ends = letter_bounds(data, offsets)
    at = np.flatnonzero(data >= 0xE0)
    if not len(at):
        return starts, ends
    wide = np.concatenate([data, np.zeros(3, data.dtype)])
    a, b, c, d = (wide[at + i].astype(np.int64) for i in range(4))
    code = np.where(a >= 0xF0, (a & 7) << 18 | (b & 63) << 12 | (c & 63) << 6 | d & 63, (a & 15) << 12 | (b & 63) << 6 | c & 63)
    alone, stop = (np.any([(code >= x) & (code <= y) for x, y in ranges], axis=0) for ranges in (UNSPACED, STOPS))
    size = np.where(a >= 0xF0, 4, 3)
    some = alone | stop
    if not some.any():
        return starts, ends
    n = len(data)
    begin, end = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    begin[starts], end[ends] = True, True
    inside = np.cumsum(np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1)) > 0
    for x in (at[some], at[some] + size[some]):
        x = x[x < n]
        x = x[inside[x] & ~begin[x]]
        begin[x] = end[x] = True
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end)
    keep = ~np.isin(starts, at[stop])
    return starts[keep], ends[keep]


def words(hasher, data, offsets):
    """(first word of each text plus the total, hashes of the words), A-Z lower-cased."""
    starts, ends = bounds(data, offsets)
    first = np.searchsorted(starts, offsets, side="left")
    return first, hasher.spans(hasher.prefix(lower(data)), starts, ends) if len(starts) else np.zeros(0, np.uint64)


def pieces(n_words: int, errors: int) -> list[tuple[int, int]]:
    """``errors`` + 1 runs of words covering the item, as even as can be: a match with at most
    that many edits leaves one of them whole."""
    cuts = [i * n_words // (errors + 1) for i in range(errors + 2)]
    return list(zip(cuts, cuts[1:]))


def myers(pattern: list, text: list) -> tuple[int, int]:
    """(fewest edits, end) of ``pattern`` against any part of ``text``, by Myers' bit-parallel
    recurrence over words; the bit vectors are integers as long as the pattern. Ties: first end."""
    m = len(pattern)
    masks: dict = {}
    for i, w in enumerate(pattern):
        masks[w] = masks.get(w, 0) | 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    for i, w in enumerate(text):
        eq = masks.get(w, 0)
        vertical = eq | minus
        across = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (full & ~(across | plus))
        down = plus & across
        if up & high:
            score += 1
        elif down & high:
            score -= 1
        up, down = (up << 1) & full, (down << 1) & full
        plus = down | (full & ~(vertical | up))
        minus = up & vertical
        if score < best:
            best, end = score, i + 1
    return best, end


class Index:
    """The pieces of a chunk of items, found by the hash of their first words."""

    def __init__(self, items: list[tuple[object, np.ndarray]], error_rate: float, min_words: int):
        self.items = [(k, w, int(len(w) * error_rate) if len(w) >= min_words else 0) for k, w in items]
        found: dict[int, list] = {}
        for at, (_, w, errors) in enumerate(self.items):
            for a, b in pieces(len(w), errors):
                found.setdefault(1 << ((b - a).bit_length() - 1), []).append((at, a, b))
        self.probes = {}
        for n, own in found.items():
            keys = np.array([chain(self.items[at][1][a:a + n], n)[0] for at, a, _ in own], np.uint64)
            order = np.argsort(keys, kind="stable")
            self.probes[n] = (keys[order], [own[i] for i in order])

    def matches(self, text: np.ndarray):
        """(item, edits, first word, end word) of every item that the text holds within its errors."""
        near: dict[int, list] = {}
        for n, (keys, own) in self.probes.items():
            grams = chain(text, n)
            lo = np.searchsorted(keys, grams, side="left")
            hits = np.flatnonzero(keys[np.minimum(lo, len(keys) - 1)] == grams)
            for i in hits:
                k = lo[i]
                while k < len(keys) and keys[k] == grams[i]:
                    at, a, b = own[k]
                    if i + b - a <= len(text) and (text[i:i + b - a] == self.items[at][1][a:b]).all():
                        near.setdefault(at, []).append(i - a)
                    k += 1
        for at, starts in near.items():
            key, item, errors = self.items[at]
            pattern, best = item.tolist(), None
            starts.sort()
            lo, hi = starts[0], starts[0]
            for s in [*starts[1:], None]:
                if s is not None and s - hi <= len(item):
                    hi = s
                    continue
                a, b = max(0, lo - errors), min(len(text), hi + len(item) + errors)
                window = text[a:b].tolist()
                edits, end = myers(pattern, window)
                if edits <= errors and (best is None or edits < best[0]):
                    _, back = myers(pattern[::-1], window[:end][::-1])
                    best = (edits, a + end - back, a + end)
                if s is not None:
                    lo = hi = s
            if best is not None:
                yield key, *best


def chain(words_, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words."""
    from_words = np.asarray(words_, np.uint64)
    m = len(from_words) - n + 1
    out = np.zeros(max(m, 0), np.uint64)
    for i in range(n if m > 0 else 0):
        out = out * np.uint64(0x9E3779B97F4A7C15) + from_words[i:i + m]
        out ^= out >> np.uint64(29)
    return out


def _match(items, error_rate, min_words, schema):
    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_type

        item_type = to_arrow_type(schema["item_id"].dataType)

        hasher, known = Hasher(), Index(items.value, error_rate, min_words)
        for b in batches:
            data, offsets = buffers(b.column("text"))
            ids, out = b.column("id").to_pylist(), []
            for i, j in slices(offsets):
                part, offs = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                first, hashes = words(hasher, part, offs)
                for d in range(i, j):
                    out += [(ids[d], *m) for m in known.matches(hashes[first[d - i]:first[d - i + 1]])]
            cols = list(zip(*out)) or [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], b.schema.field("id").type), pa.array(cols[1], item_type), pa.array(cols[2], pa.int32()),
                 pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())],
                names=["id", "item_id", "edits", "first_word", "end_word"])
    return run


def _chunks(benchmark: DataFrame, item_col: str, text_col: str):
    """The items in lists of about ``CHUNK_BYTES`` of text each, read one partition at a time."""
    chunk, size = [], 0
    rows = benchmark.filter(F.col(item_col).isNotNull() & F.col(text_col).isNotNull())
    for r in rows.select(F.col(item_col).alias("k"), F.col(text_col).cast("string").alias("t")).toLocalIterator():
        raw = r.t.encode()
        chunk.append((r.k, raw))
        size += len(raw)
        if size >= CHUNK_BYTES:
            yield chunk
            chunk, size = [], 0
    if chunk:
        yield chunk


def _clean(items, error_rate, min_words, text_col):
    def run(batches):
        import pyarrow as pa

        hasher, known = Hasher(), Index(items.value, error_rate, min_words)
        for b in batches:
            data, offsets = buffers(b.column(text_col))
            keep = np.ones(len(offsets) - 1, bool)
            for i, j in slices(offsets):
                first, hashes = words(hasher, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                for d in range(i, j):
                    keep[d] = next(known.matches(hashes[first[d - i]:first[d - i + 1]]), None) is None
            yield b.filter(pa.array(keep))
    return run


def _items(spark, chunk, min_words):
    """Broadcast (item id, word hashes) of a chunk, of items with enough words or bytes."""
    raw = np.frombuffer(b"".join(t for _, t in chunk), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for _, t in chunk])]).astype(np.int64)
    first, hashes = words(Hasher(), raw, offsets)
    starts, ends = bounds(raw, offsets)
    size = np.concatenate([[0], np.cumsum(ends - starts)])
    return spark.sparkContext.broadcast([(k, hashes[a:b]) for (k, _), a, b in zip(chunk, first, first[1:])
                                         if b > a and (b - a >= min_words or size[b] - size[a] >= MIN_BYTES)])


def without_leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, min_words: int = MIN_WORDS,
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``docs`` without the rows in which ``find_leaks`` finds an item; all columns stay, and no row moves."""
    for chunk in _chunks(benchmark, item_col, item_text_col):
        docs = docs.mapInArrow(_clean(_items(docs.sparkSession, chunk, min_words), error_rate, min_words, text_col), docs.schema)
    return docs


def find_leaks(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, min_words: int = MIN_WORDS,
               id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text") -> DataFrame:
    """Benchmark items held by documents, up to a share of edited words.

    Words are runs of letters and digits, A-Z lower-cased, and single characters in scripts without spaces, so case,
    punctuation and line breaks don't matter. An item of n words matches a part of a text within
    e = floor(``error_rate`` * n) inserted, lost or changed words. It is split into e + 1 pieces,
    of which a match holds one whole; exact piece hits in the text name places, and Myers'
    bit-parallel distance checks them. Nothing is shuffled: each chunk of the benchmark
    (about 8 MB) is broadcast in a pass over the whole texts.

    Ids of items and documents keep their types. Returns one row a document row and item: id, ``item_id``, ``edits``, ``first_word`` and
    ``end_word`` (the best match; the first of equals). Null and empty texts, items with a null id or text, and
    items of fewer than ``min_words`` words and 12 bytes match nothing, those of fewer words only without edits; repeated rows match each by itself; items that
    repeat an id are matched each. Empty tables give no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = (rows.select("id").schema.add("item_id", benchmark.schema[item_col].dataType)
              .add("edits", IntegerType()).add("first_word", LongType()).add("end_word", LongType()))
    out = None
    for chunk in _chunks(benchmark, item_col, item_text_col):
        found = rows.mapInArrow(_match(_items(spark, chunk, min_words), error_rate, min_words, schema), schema)
        out = found if out is None else out.unionByName(found)
    out = spark.createDataFrame([], schema) if out is None else out
    return out.withColumnRenamed("id", id_col)
