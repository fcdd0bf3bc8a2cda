"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from tests.llm.helpers import LOWER, documents, odd_rows
from tussock.llm import spelling
from tussock.llm.queries import QUERIES
from tussock.llm.spelling import Trie, near_words, one_edit, spelling_variants, vector


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def brute(rows, least=5):
    counts = Counter()
    for r in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", r[1] or ""):
            low = run.translate(LOWER)
            h = zlib.crc32(f"{'' if r[0] is None else r[0]}:{low}".encode())
            if h % 199 == 0:
                i = h % len(low)
                low = low[:i] + low[i + 1:]
            counts[low] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= least}
    near = {w: [v for v in words if abs(len(v) - len(w)) < 2 and levenshtein(v, w) == 1] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n, len(near[w]), words[form[w]] if form[w] else None)
    return out


def result(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def texts(seed, n):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(6, 9))) for _ in range(60)]
    out = []
    for i in range(n):
        line = []
        for _ in range(80):
            w = base[min(int(rng.expovariate(0.08)), len(base) - 1)]
            if rng.random() < 0.1:
                p = rng.randrange(len(w))
                w = rng.choice([w[:p] + w[p + 1:], w[:p] + rng.choice("abÉz") + w[p:], w[:p] + rng.choice("abÖz") + w[p + 1:]])
            line.append(w.upper() if rng.random() < 0.1 else w)
        out.append((i, " ".join(line) + ", 12x"))
    return out


def test_variants_equal_brute_force(spark):
    rows = texts(1, 120) + odd_rows() + [(None, "abcabcabc " * 7), (7, None), (900, "garden " * 400 + "gardem " * 50 + "gaardem " * 6)]
    want = brute(rows)
    assert result(spelling_variants(documents(spark, rows))) == want
    assert sum(v[0] is not None for v in want.values()) > 20 and any(want[v[0]][0] for v in want.values() if v[0])


def test_crowded_vectors_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(spelling, "TRIE_WORDS", 5)
    rows = texts(2, 80)
    assert result(spelling_variants(documents(spark, rows))) == brute(rows)


def test_tries_find_every_word_one_edit_away():
    rng = random.Random(3)
    words = list({"".join(rng.choice("abcd") for _ in range(rng.randint(3, 6))) for _ in range(400)})
    trie, asking = Trie(), Trie()
    for w in words:
        trie.add(w, vector(w))
    for w in words[:80]:
        asking.add(w, vector(w))
    found = {(a, b) for ones, others in trie.near(asking) for a in ones for b in others}
    assert {(a, b) for a in words[:80] for b in words if levenshtein(a, b) == 1} == {(a, b) for a, b in found if one_edit(a, b)}


def test_one_edit():
    pairs = [("abc", "abc"), ("abc", "abd"), ("abc", "ab"), ("abc", "xabc"), ("abc", "axbc"), ("abc", "acb"), ("", "a"), ("", "ab"), ("aa", "aaa"), ("é", "e")]
    for a, b in pairs:
        assert one_edit(a, b) == one_edit(b, a) == (levenshtein(a, b) == 1)


def test_pairs_are_found_once_in_each_direction(spark):
    df = spark.createDataFrame([(w, 1) for w in ("ladder", "laddr", "ladders", "madder", "adder", "zzzzzz")], "word string, n long")
    got = sorted((r.word, r.other) for r in near_words(df).collect())
    want = sorted((a, b) for a in ("ladder", "laddr", "ladders", "madder", "adder") for b in ("ladder", "laddr", "ladders", "madder", "adder")
                  if levenshtein(a, b) == 1)
    assert got == want


def test_empty_table_and_query(spark):
    assert spelling_variants(documents(spark, [])).collect() == []
    assert spelling_variants(documents(spark, [(1, None), (2, "short")])).collect() == []
    out = QUERIES["op12_spelling_variants"](spark, "/root/testdata/sf0.001")
    assert dict(out.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert result(out) == brute(rows)
