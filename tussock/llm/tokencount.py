"""Token counts under a unigram vocabulary, by dynamic programming over a trie of pre-tokens."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textbytes import Hasher, buffers, slices, word_bounds

#: Put before every pre-token, as the vocabularies spell a word's start.
MARK = "▁"
#: A character outside the vocabulary costs this much more than the worst piece.
UNKNOWN_PENALTY = 10.0
#: Distinct pre-tokens whose counts a task remembers between slices.
REMEMBERED = 1_000_000
#: Bytes of text whose pre-tokens share a trie.
TRIE_BYTES = 2 << 20


def is_unigram(model: bytes) -> bool:
    """Whether a sentencepiece model (its bytes) is a unigram one: field 3 of its trainer's settings, field 2; 1 if missing."""
    def fields(raw):
        at = 0

        def number():
            nonlocal at
            n = shift = 0
            while True:
                n |= (raw[at] & 127) << shift
                shift, at = shift + 7, at + 1
                if raw[at - 1] < 128:
                    return n

        while at < len(raw):
            key = number()
            if key & 7 == 0:
                yield key >> 3, number()
                continue
            size = number() if key & 7 == 2 else {1: 8, 5: 4}[key & 7]
            yield key >> 3, raw[at:at + size]
            at += size

    kind = 1
    for field, settings in fields(model):
        if field == 2:
            for name, value in fields(settings):
                kind = value if name == 3 else kind
    return kind == 1


def read_pieces(path: str) -> dict[str, float]:
    """Piece to log score, from a sentencepiece file: its normal pieces.

    A unigram file's scores are taken as they are. The scores of other files (BPE) only order the pieces, so there a
    piece of rank r scores -ln(r + 10), as word frequencies fall with the rank.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size())
           if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    own = is_unigram(model.serialized_model_proto())
    return {model.id_to_piece(i): model.get_score(i) if own else -math.log(r + 10) for r, i in enumerate(ids)}


def trie_counts(words: list[str], pieces: dict[str, float], longest: int) -> list[int]:
    """Tokens of the best segmentation of each of the sorted, distinct ``words``.

    Sorted words walk the trie of all words depth first: ``best`` and ``tokens`` hold the forward
    scores and counts along the current path, so a prefix that words share is worked out once. A
    word's count is read at its last node. An unknown character counts its UTF-8 bytes.
    """
    unknown = min(pieces.values(), default=0.0) - UNKNOWN_PENALTY
    best, tokens, out, before = [0.0], [0], [], ""
    get = pieces.get
    for w in words:
        keep, most = 0, min(len(w), len(before))
        while keep < most and w[keep] == before[keep]:
            keep += 1
        del best[keep + 1:], tokens[keep + 1:]
        for end in range(keep + 1, len(w) + 1):
            top, n = -math.inf, 0
            for start in range(max(0, end - longest), end):
                s = get(w[start:end])
                if s is not None and best[start] + s > top:
                    top, n = best[start] + s, tokens[start] + 1
            if get(w[end - 1]) is None and best[end - 1] + unknown > top:
                top, n = best[end - 1] + unknown, tokens[end - 1] + len(w[end - 1].encode())
            best.append(top)
            tokens.append(n)
        out.append(tokens[-1])
        before = w
    return out


def _counted(vocabulary):
    def run(batches):
        import pyarrow as pa

        pieces, hasher = vocabulary.value, Hasher()
        longest = max(map(len, pieces), default=1)
        known, n_of = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for b in batches:
            data, offsets = buffers(b.column("text"))
            tokens, words = np.zeros(len(offsets) - 1, np.int64), np.zeros(len(offsets) - 1, np.int64)
            for i, j in slices(offsets, TRIE_BYTES):
                part, offs = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
                starts, ends = word_bounds(part, offs)
                if not len(starts):
                    continue
                keys, at, back = np.unique(hasher.spans(hasher.prefix(part), starts, ends), return_index=True, return_inverse=True)
                place = np.searchsorted(known, keys)
                place[place == len(known)] = 0
                old = known[place] == keys if len(known) else np.zeros(len(keys), bool)
                n = np.where(old, n_of[place] if len(known) else 0, 0)
                new = np.flatnonzero(~old)
                raw = part.tobytes()
                texts = [MARK + raw[starts[k]:ends[k]].decode("utf-8", "replace") for k in at[new]]
                order = sorted(range(len(texts)), key=texts.__getitem__)
                n[new[order]] = trie_counts([texts[k] for k in order], pieces, longest)
                first = np.searchsorted(starts, offs, side="left")
                total = np.concatenate([[0], np.cumsum(n[back])])
                tokens[i:j], words[i:j] = total[first[1:]] - total[first[:-1]], np.diff(first)
                if len(known) + len(new) <= REMEMBERED:
                    known = np.concatenate([known, keys[new]])
                    n_of = np.concatenate([n_of, n[new]])
                else:
                    known, n_of = keys, n
                order = np.argsort(known)
                known, n_of = known[order], n_of[order]
            names = [x for x in b.schema.names if x != "text"]
            yield pa.RecordBatch.from_arrays([*(b.column(x) for x in names), pa.array(words), pa.array(tokens)],
                                             names=[*names, "n_words", "n_tokens"])
    return run


def token_counts(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokens of every whole text under the unigram vocabulary in a sentencepiece file.

    Pre-tokens are the words ``[^\\x20\\x09-\\x0D]+`` with a word-start mark before them. The distinct
    pre-tokens of a slice of texts form a trie; forward scores (best log score of any segmentation)
    are worked out once a node, and each pre-token's count is kept for the task. Ties go to the
    longer last piece. Nothing is shuffled.

    Returns id, ``n_words``, ``n_tokens`` and ``n_bytes``. Null and empty texts have 0 of each. Repeated rows
    are counted each; null ids are kept; an empty table gives no rows; further columns are not read.
    """
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
                       text.alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    pieces = spark.sparkContext.broadcast(read_pieces(vocabulary_path))
    out = rows.mapInArrow(_counted(pieces), f"id {kind}, n_bytes long, n_words long, n_tokens long")
    return out.select(F.col("id").alias(id_col), "n_words", "n_tokens", "n_bytes")
