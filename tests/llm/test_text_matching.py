"""Decontamination, near duplicates, components and repeat removal against brute force."""

import hashlib
import re
from collections import Counter
from decimal import Decimal

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.helpers import documents, odd_rows, words
from tussock.llm import decontam, jaccard, store, suffix
from tussock.llm.components import connected_components

SF = "/root/testdata/sf0.001"


def _edits(pattern, text):
    """(fewest edits, first end) of the pattern against any part of the text, by the full table."""
    row, best = list(range(len(pattern) + 1)), (len(pattern), 0)
    for e, w in enumerate(text, 1):
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i - 1] + (p != w), row[i] + 1, new[i - 1] + 1))
        row = new
        if row[-1] < best[0]:
            best = (row[-1], e)
    return best


@given(st.lists(st.integers(0, 4), min_size=1, max_size=80), st.lists(st.integers(0, 4), max_size=60))
@settings(max_examples=200, deadline=None)
def test_myers_equals_the_full_table(pattern, text):
    assert decontam.myers(pattern, text) == _edits(pattern, text)


@given(st.integers(1, 60), st.integers(0, 12))
def test_pieces_cover_the_item(n, errors):
    cut = decontam.pieces(n, errors)
    assert len(cut) == errors + 1 and cut[0][0] == 0 and cut[-1][1] == n
    assert all(a[1] == b[0] for a, b in zip(cut, cut[1:]))


def _letters(text):
    return re.findall(r"[0-9a-zA-Z\x80-\U0010ffff]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def test_leaks_with_edits_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [(k, " ".join(rng.choice(vocabulary, int(rng.integers(6, 45))))) for k in range(12)] + [(50, "too short"), (51, None), (None, "null item " * 9)]
    rows = []
    for d in range(120):
        w = list(rng.choice(vocabulary, int(rng.integers(0, 120))))
        if d % 3 == 0:
            leak = items[d % 12][1].split()
            for _ in range(int(rng.integers(0, 9))):
                at = int(rng.integers(0, len(leak)))
                leak[at:at + 1] = [[], ["new"], [leak[at], "more"]][int(rng.integers(0, 3))]
                leak = leak or ["x"]
            w[5:5] = leak
        rows.append((d, ", ".join(w).upper() if d % 2 else "\n".join(w)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.edits for r in decontam.find_leaks(documents(spark, rows), bench).collect()}
    want = {}
    for d, t in rows:
        for k, item in items:
            p = _letters(item)
            if k is not None and len(p) >= decontam.MIN_WORDS:
                e, _ = _edits(p, _letters(t))
                if e <= int(len(p) * decontam.ERROR_RATE):
                    want[d, k] = e
    assert got == want and len(want) > 10
    clean = decontam.without_leaks(documents(spark, rows), bench)
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in rows} - {d for d, _ in want}
    assert clean.columns == documents(spark, rows).columns


def test_short_items_and_scripts_without_spaces(spark):
    chinese = "春天的早晨,孩子们在河边看见了一只白色的鸟。它慢慢地飞过了山。"
    bench = spark.createDataFrame([(1, "Photosynthesis needs chlorophyll"), (2, chinese), (3, "ประเทศไทยสวยมาก"), (4, "tiny")], "item_id long, text string")
    rows = [(1, "Why photosynthesis needs chlorophyll, they said"), (2, "photosynthesis needs no chlorophyll"), (3, "前言" + chinese.replace(",", "、").replace("白", "黑") + "后记"),
            (4, "abcประเทศไทยสวยมากdef"), (5, "a tiny text"), (6, "孩子们在河边"), (7, "光、"), (8, chinese[:4] + "é x")]
    got = {(r.doc_id, r.item_id, r.edits) for r in decontam.find_leaks(documents(spark, rows), bench).collect()}
    assert got == {(1, 1, 0), (3, 2, 1), (4, 3, 0)}


@pytest.mark.parametrize("kind, ids", [("string", ["a-1", "b/2"]), ("int", [1, 2]), ("decimal(20,0)", [Decimal(10 ** 19), Decimal(2)])])
def test_item_ids_keep_their_type(spark, kind, ids):
    bench = spark.createDataFrame([(ids[0], "one two three four five six"), (ids[1], "never said before by anyone here"), (None, "one two three four five six")],
                                  f"item_id {kind}, text string")
    found = decontam.find_leaks(documents(spark, odd_rows()), bench)
    assert found.schema["item_id"].dataType == bench.schema["item_id"].dataType
    assert sorted((r.doc_id, r.item_id) for r in found.collect()) == [(8, ids[0]), (9, ids[0])]
    assert decontam.without_leaks(documents(spark, odd_rows()), bench).count() == len(odd_rows()) - 2
    assert decontam.find_leaks(documents(spark, odd_rows()), bench.limit(0)).schema == found.schema


def test_leaks_in_chunks_and_odd_rows(spark, monkeypatch):
    bench = spark.createDataFrame([(1, "one two three four five six"), (2, "long text long text long text")], "item_id long, text string")
    docs = documents(spark, odd_rows())
    whole = sorted(tuple(r) for r in decontam.find_leaks(docs, bench).collect())
    monkeypatch.setattr(decontam, "CHUNK_BYTES", 1)
    assert sorted(tuple(r) for r in decontam.find_leaks(docs, bench).collect()) == whole
    assert {(r[0], r[1]) for r in whole} == {(8, 1), (9, 1), (6, 2)}
    assert decontam.find_leaks(documents(spark, []), bench).count() == 0
    assert decontam.find_leaks(docs, bench.limit(0)).count() == 0
    assert decontam.without_leaks(docs, bench.limit(0)).count() == len(odd_rows())


def _shingles(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def _components(rows):
    sets = [_shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(root(i), []).append(i)
    out = []
    for i in range(len(rows)):
        ids = [rows[k][0] for k in groups[root(i)] if rows[k][0] is not None]
        out.append((rows[i][0], len(sets[i]), min(ids) if ids else None))
    return Counter(out)


def _near(rng, text, rate):
    w = text.split()
    for i in range(len(w)):
        if rng.random() < rate:
            w[i] = f"new{rng.integers(1 << 30)}"
    return " ".join(w)


@pytest.mark.parametrize("rounds", [1, 6])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, rounds):
    monkeypatch.setattr(jaccard, "GROUP_POSTINGS", 300)
    monkeypatch.setattr(jaccard, "HOT_TOKEN", 25)
    monkeypatch.setattr(jaccard, "PIVOT_ROUNDS", rounds)
    rng = np.random.default_rng(rounds)
    passage = " ".join(f"p{i}" for i in range(30))
    rows, order = [], rng.permutation(400)
    for i in range(60):
        base = " ".join(f"v{x}" for x in rng.integers(0, 4000, int(rng.integers(1, 90))))
        rows += [(0, base)] + [(0, _near(rng, base, r)) for r in (0.0, 0.01, 0.02, 0.03, 0.05)[: int(rng.integers(0, 6))]]
        if i % 4 == 0:
            rows.append((0, passage + " " + base))
    hub = " ".join(f"h{i}" for i in range(100))
    rows += [(0, _near(rng, hub, 0.015)) for _ in range(40)] + [(0, hub)]
    chain = [f"c{i}" for i in range(160)]
    rows += [(0, " ".join(chain[i:i + 100])) for i in range(0, 60, 6)]
    rows = [(int(order[i % 400]) * 3 + i // 400, t) for i, (_, t) in enumerate(rows)] + [r[:2] for r in odd_rows()]
    out = jaccard.near_duplicates(documents(spark, rows))
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in out.collect())
    assert got == _components(rows)


def test_one_of_each(spark):
    rows = [(3, "a b c d e f g h"), (2, "a b c d e f g h"), (2, "a b c d e f g h"), (9, "other words are here now"), (None, "a b c d e f g h"),
            (None, None), (5, None), (6, ""), (7, "x"), (7, "x")]
    docs = documents(spark, rows)
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    assert {tuple(r[5:]) for r in kept.collect()} == {("x",) * (len(docs.columns) - 5)}
    assert got == Counter([(2, "a b c d e f g h"), (9, "other words are here now"), (None, None), (5, None), (6, ""), (7, "x")])
    assert jaccard.one_of_each(docs.limit(0)).count() == 0
    assert jaccard.near_duplicates(docs.limit(0)).count() == 0


def test_one_of_each_group_without_ids(spark):
    text = [" ".join(f"{x}{i}" for i in range(60)) for x in "abc"]
    rows = [(None, text[0]), (None, text[0]), (None, text[0] + " more"), (None, text[1]), (None, None), (None, ""), (1, text[2]), (None, text[2])]
    got = Counter((r.doc_id, r.text) for r in jaccard.one_of_each(documents(spark, rows)).collect())
    near = [got.pop((None, t), 0) for t in (text[0], text[0] + " more")]
    assert sorted(near) == [0, 1]
    assert got == Counter([(None, text[1]), (None, None), (None, ""), (1, text[2])])


@given(st.sets(st.integers(0, 5000), min_size=1, max_size=200), st.integers(0, 1000))
@settings(max_examples=60, deadline=None)
def test_prefixes_ask_for_matches_that_linked_sets_have(values, seed):
    rng = np.random.default_rng(seed)
    counts = rng.integers(0, 50, jaccard.COUNTERS).astype(np.uint32)
    x = np.array(sorted(values), np.uint64)
    y = np.union1d(x[rng.random(len(x)) < 0.95], rng.integers(6000, 9000, len(x) // 10).astype(np.uint64))
    both = len(np.intersect1d(x, y))
    if not len(y) or 100 * both < 80 * len(np.union1d(x, y)):
        return
    (px, mx), (py, my) = (jaccard.prefix(s, counts, 1.0, 80) for s in (x, y))
    need, asked = -(-80 * (len(x) + len(y)) // 180), min(mx, my)
    assert len(np.intersect1d(px[:len(x) - need + asked], py[:len(y) - need + asked])) >= asked


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40), st.sampled_from([0, 500_000]))
@settings(max_examples=6, deadline=None)
def test_components_equal_union_find(spark, edges, most):
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(store, "BROADCAST_ROWS", most)
        _check_components(spark, edges)


def _check_components(spark, edges):
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    group = {n: {n} for e in edges for n in e}
    for a, b in edges:
        if group[a] is not group[b]:
            group[a] |= group[b]
            for n in group[b]:
                group[n] = group[a]
    assert got.keys() == group.keys()
    for a in group:
        assert {n for n in got if got[n] == got[a]} == group[a]


def _matches(text, ends):
    """Longest common prefix with any other place, by the naive comparison."""
    strings = np.split(text, ends + 1)[:-1]
    where = [(s, p) for s, t in enumerate(strings) for p in range(len(t))]
    out = []
    for s, p in where:
        best = 0
        for s2, p2 in where:
            if (s, p) != (s2, p2):
                n = 0
                while (p + n < len(strings[s]) - 1 and p2 + n < len(strings[s2]) - 1
                       and strings[s][p + n] == strings[s2][p2 + n]):
                    n += 1
                best = max(best, n)
        out.append(best)
    return out


@given(st.lists(st.text("ab", max_size=25), min_size=1, max_size=5))
@settings(max_examples=150, deadline=None)
def test_matching_statistics_equal_the_naive_ones(strings):
    text = np.concatenate([np.array([ord(c) + 1 for c in s] + [0], np.uint16) for s in strings])
    ends = np.cumsum([len(s) + 1 for s in strings]) - 1
    assert suffix.matching_statistics(text, ends).tolist() == _matches(text, ends)


@given(st.lists(st.integers(0, 50), min_size=1, max_size=60), st.integers(1, 70))
def test_sliding_least(values, width):
    v = np.array(values, np.uint64)
    if width <= len(v):
        assert suffix.sliding_least(v, width).tolist() == [min(values[i:i + width]) for i in range(len(v) - width + 1)]


def _without_repeats(rows, length):
    seen = Counter(b[p:p + length] for _, t in rows for b in [(t or "").encode()] for p in range(len(b) - length + 1))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                gone[p:p + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("groups,index,hot", [(200_000, 1 << 20, 20_000), (40, 3000, 20_000), (40, 3000, 6)])
def test_repeats_equal_brute_force(spark, monkeypatch, groups, index, hot):
    monkeypatch.setattr(suffix, "HOT_STRETCHES", hot)
    monkeypatch.setattr(suffix, "GROUP_STRETCHES", groups)
    monkeypatch.setattr(suffix, "INDEX_BYTES", index)
    rng = np.random.default_rng(groups)

    def prose(n):
        return " ".join("".join(rng.choice(list("abcdéf"), int(rng.integers(2, 8)))) for _ in range(n))

    passages = [prose(60) for _ in range(5)]
    rows = [(i, prose(40) + passages[i % 5][int(rng.integers(0, 150)):] + prose(30)) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(5)]
    rows += [(200 + i, rows[i][1][:200] + "X" + rows[i][1][200:]) for i in range(10)]
    rows += [(300, "abc" * 400), (301, "z" * 90), (302, "z" * 81 + "y" + "z" * 81), (303, "q" * 79), (304, "q" * 79), (305, prose(50) * 3)]
    rows += [(None, passages[0]), (None, passages[0]), (400, None), (401, ""), (401, "")]
    got = Counter(tuple(r)[:5] for r in suffix.remove_repeats(documents(spark, rows), length=80).collect())
    assert got == _without_repeats(rows, 80)


def test_repeats_of_given_documents_equal_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = Counter(tuple(r)[:5] for r in suffix.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == _without_repeats(rows, 200)
    empty = suffix.remove_repeats(documents(spark, []))
    assert empty.count() == 0
    odd = suffix.remove_repeats(documents(spark, odd_rows())).filter(F.col("doc_id").isin(1, 2, 3)).collect()
    assert {r.n_removed for r in odd} == {0}


def test_hot_stretches_are_counted_by_kind_before_any_is_cut_out(spark, monkeypatch):
    """Of a large group of near copies one stretch of each kind is cut out, as on the normal path."""
    rng = np.random.default_rng(8)
    base = ["".join(rng.choice(list("abcdefg"), int(rng.integers(2, 8)))) for _ in range(300)]
    rows = []
    for i in range(150):
        words_ = list(base)
        words_[int(rng.integers(0, 300))] = f"x{i % 40}x"
        rows.append((i, " ".join(words_)))
    sizes = {}
    for most in (20_000, 20):
        monkeypatch.setattr(suffix, "HOT_STRETCHES", most)
        kinds = []
        told = suffix.stored

        def watched(df, name, told=told, kinds=kinds):
            out = told(df, name)
            if name == "rep-met":
                kinds.append(out.filter("kind > 0").count())
            return out

        monkeypatch.setattr(suffix, "stored", watched)
        got = Counter(tuple(r)[:5] for r in suffix.remove_repeats(documents(spark, rows), length=120).collect())
        monkeypatch.setattr(suffix, "stored", told)
        assert got == _without_repeats(rows, 120)
        sizes[most] = kinds[0]
    assert sizes[20] < 2 * sizes[20_000] + 100
