"""Spelling variants of words by a trie of letter-group counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import sided, stored

#: Letters fall into so many groups (by code point); their counts are a word's vector, one trie level each.
GROUPS = 12
#: So many neighbouring groups make one coarse group; words meet by their counts of coarse groups.
COARSE = 3
#: Words of a trie. A count vector with more of them is dealt out to several tries.
TRIE_WORDS = 4000
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def vector(word: str) -> tuple[int, ...]:
    """How many letters of the word each group has."""
    counts = [0] * GROUPS
    for c in word:
        counts[ord(c) % GROUPS] += 1
    return tuple(counts)


def coarse(counts) -> tuple[int, ...]:
    return tuple(sum(counts[i:i + COARSE]) for i in range(0, GROUPS, COARSE))


def reach(key):
    """The coarse counts of all words one edit away: a surplus of at most one and a deficit of at most one."""
    out, k = [key], range(len(key))
    for up in (None, *k):
        for down in (None, *k):
            if up == down:
                continue
            other = list(key)
            if up is not None:
                other[up] += 1
            if down is not None:
                other[down] -= 1
            if min(other) >= 0:
                out.append(tuple(other))
    return out


def one_edit(a: str, b: str) -> bool:
    """The words differ by exactly one inserted, deleted or replaced code point."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return i < len(a) and a[i + 1:] == b[i + 1:]
    return a[i:] == b[i + 1:]


class Trie:
    """Words by successive letter-group counts; a leaf holds the words of one vector."""

    def __init__(self):
        self.root: dict = {}

    def add(self, word: str, counts) -> None:
        node = self.root
        for c in counts[:-1]:
            node = node.setdefault(c, {})
        node.setdefault(counts[-1], []).append(word)

    def near(self, asking: "Trie"):
        """Leaves of ``asking`` with the leaves here whose vector is within a surplus of one and a deficit of one.

        Both tries are searched together, depth first, so vectors with a common beginning share its steps.
        """
        stack = [(asking.root, self.root, 1, 1, 1)]
        while stack:
            ask, node, level, surplus, deficit = stack.pop()
            found = [(a, node[c], surplus, deficit) for c, a in ask.items() if c in node]
            if surplus:
                found += [(a, node[c + 1], 0, deficit) for c, a in ask.items() if c + 1 in node]
            if deficit:
                found += [(a, node[c - 1], surplus, 0) for c, a in ask.items() if c - 1 in node]
            if level == GROUPS:
                for a, b, _, _ in found:
                    yield a, b
            else:
                stack += [(a, b, level + 1, up, down) for a, b, up, down in found]


def _visits(batches):
    """Every word under its own coarse counts (as a resident) and under the higher ones in reach (as a visitor)."""
    import pyarrow as pa

    for b in batches:
        out = []
        for word, n in zip(b.column("word").to_pylist(), b.column("n").to_pylist()):
            own = coarse(vector(word))
            out += [(",".join(map(str, key)), word, n, key == own) for key in reach(own) if key >= own]
        cols = list(zip(*out)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64()),
                                          pa.array(cols[3], pa.bool_())], names=["key", "word", "n", "own"])


def _keys(batches):
    """The coarse counts of every word."""
    import pyarrow as pa

    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([",".join(map(str, coarse(vector(w)))) for w in b.column("word").to_pylist()], pa.string())], names=["key"])


def _near(table):
    """Pairs of near words of a part, each once: a word looks for residents that follow it by (coarse counts, word)."""
    import pyarrow as pa

    trie, asking, known, n_of = Trie(), Trie(), set(), {}
    for word, n, own in zip(table.column("word").to_pylist(), table.column("n").to_pylist(), table.column("own").to_pylist()):
        counts = vector(word)
        if word not in n_of:
            asking.add(word, counts)
            n_of[word] = n
        if own and word not in known:
            trie.add(word, counts)
            known.add(word)
    out = []
    for words, others in trie.near(asking):
        key, other_key = coarse(vector(words[0])), coarse(vector(others[0]))
        if other_key < key:
            continue
        for a in words:
            for b in others:
                if (key < other_key or a < b) and one_edit(a, b):
                    out += [(a, b, n_of[b]), (b, a, n_of[a])]
    cols = list(zip(*out)) or [[]] * 3
    return pa.table({"word": pa.array(cols[0], pa.string()), "other": pa.array(cols[1], pa.string()), "m": pa.array(cols[2], pa.int64())})


def near_words(words: DataFrame) -> DataFrame:
    """(word, other, m) for all words of (word, n) that are one edit apart, in both directions; m: the other's n.

    A word's vector counts its letters by group, and one edit adds at most one to one group and takes at most one
    from one. Words meet in parts by the counts of coarse groups: each word lives under its own and visits those
    in reach that come later. A part's residents form a trie of the vectors; depth-first search spends
    a surplus of one and a deficit of one, and the words of the leaves it ends at are compared letter by letter. A count
    vector with more than ``TRIE_WORDS`` words is dealt out to several tries, and its visitors go to each.
    """
    visits = words.mapInArrow(_visits, "key string, word string, n long, own boolean")
    size = words.count()
    heavy = stored(words.mapInArrow(_keys, "key string").groupBy("key").count().filter(F.col("count") > TRIE_WORDS)
                   .select("key", F.ceil(F.col("count") / TRIE_WORDS).alias("blocks")), "spell-heavy")
    dealt = visits.join(sided(heavy), "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long")))
    mine = F.pmod(F.xxhash64("word"), F.col("blocks"))
    dealt = dealt.select("key", "word", "n", "own", mine.alias("mine"),
                         F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    parts = max(1, -(-size // TRIE_WORDS)) * 4
    dealt = dealt.select(F.pmod(F.xxhash64("key", "block"), F.lit(parts)).alias("part"), "word", "n",
                         (F.col("own") & (F.col("mine") == F.col("block"))).alias("own"))
    return dealt.groupBy("part").applyInArrow(_near, "word string, other string, m long")


def count_words(docs: DataFrame, drop_one_in: int = 199, least_letters: int = 6, least_count: int = 5,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): runs of letters, A-Z lower-cased; in one of ``drop_one_in`` (document, run), by hash, a letter goes missing."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    runs = F.regexp_extract_all(text, F.lit(f"([A-Za-zÀ-ÿ]{{{least_letters},}})"), F.lit(1))
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    rows = rows.select("id", F.translate("run", UPPER, UPPER.lower()).alias("run"))
    rows = rows.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = F.pmod("h", F.length("run").cast("long")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    rows = rows.select(F.when(F.col("h") % drop_one_in == 0, cut).otherwise(F.col("run")).alias("word"))
    return (rows.filter(F.length("word") >= least_letters).groupBy("word").agg(F.count("*").alias("n"))
            .filter(F.col("n") >= least_count))


def spelling_variants(docs: DataFrame, ratio: int = 5, drop_one_in: int = 199, least_letters: int = 6, least_count: int = 5,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every frequent word with the more frequent word that it is probably a spelling of.

    Words are the maximal runs of ``[A-Za-z\\u00C0-\\u00FF]`` of the whole texts, A-Z lower-cased, with a letter
    taken out of one in ``drop_one_in`` (document, run) by hash; those of at least ``least_letters`` code points and
    ``least_count`` occurrences count. Near words (``near_words``) are one inserted, deleted or replaced code point apart. A
    word's ``form`` is its near word of largest n (ties: smallest in code-point order) if that n is at least ``ratio`` times
    its own; ``root`` is where following forms ends.

    Returns word, ``form``, ``root``, ``n``, ``n_near``, ``form_n``: one row a word. Null texts have no words, null ids hash
    as empty, repeated rows count each. Very long runs are words like any other. Tables without
    such words, or without rows, give no rows; further columns are not read.
    """
    words = stored(count_words(docs, drop_one_in, least_letters, least_count, id_col, text_col), "spell-words")
    best = F.min(F.struct((-F.col("m")).alias("neg"), "other")).alias("best")
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    fits = -F.col("best.neg") >= ratio * F.col("n")
    known = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(fits, F.col("best.other")).alias("form"),
        F.when(fits, -F.col("best.neg")).alias("form_n")), "spell-forms")
    # n grows ``ratio`` times with each step, so chains are short; each round doubles the steps taken.
    up = stored(known.filter("form is not null").select("word", F.col("form").alias("root")), "spell-up")
    while True:
        step = up.select(F.col("word").alias("root"), F.col("root").alias("further"))
        further = stored(up.join(sided(step), "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                                     F.col("further").isNotNull().alias("moved")), "spell-up")
        up = further.select("word", "root")
        if further.filter("moved").isEmpty():
            break
    return (known.join(up, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
