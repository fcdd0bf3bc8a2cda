"""Byte helpers, sharding, mixing, top-k and token counts against brute force."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import CLASHING, documents, odd_rows, words
from tussock.llm import mixing, sharding, textbytes, tokencount, topk

SF = "/root/testdata/sf0.001"


def test_words_match_the_pattern():
    texts = ["", "a b", " Ünï\tcödé\x0bX ", None, "x" * 300, "\n", "a\x00b \x85c"]
    data, offsets = textbytes.buffers(pa.array(texts))
    starts, ends = textbytes.word_bounds(data, offsets)
    got = [data[s:e].tobytes().decode().lower() for s, e in zip(starts, ends)]
    assert got == [w.lower() for t in texts for w in words(t)]
    first, hashes = textbytes.word_hashes(textbytes.Hasher(), data, offsets)
    assert len(set(hashes.tolist())) == len({w for t in texts for w in words(t)})
    assert first[-1] == len(hashes)


def test_hash_does_not_depend_on_place():
    h = textbytes.Hasher()
    a = np.frombuffer(b"xx hello yy", np.uint8)
    b = np.frombuffer(b"hello", np.uint8)
    pa_, pb = h.prefix(a), h.prefix(b)
    assert h.spans(pa_, np.array([3]), np.array([8])) == h.spans(pb, np.array([0]), np.array([5]))


def test_shards_are_even_and_keep_groups(spark):
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(["w"] * int(rng.integers(1, 60))) + f" t{i // 2}") for i in range(3000)]
    out = sharding.shard(documents(spark, rows), n_shards=8).toPandas()
    text = dict(rows)
    assert (out["size"] == [len(text[i].encode()) + 8 for i in out.doc_id]).all()
    assert (out.text_crc32 == [zlib.crc32(text[i].encode()) for i in out.doc_id]).all()
    by = out.groupby("shard")
    for c in ("size", "tokens"):
        sums = by[c].sum()
        assert sums.max() / sums.mean() < 1.03 and sums.min() / sums.mean() > 0.97
    for _, g in by:
        assert sorted(g.slot) == list(range(len(g)))
    where = defaultdict(set)
    for r in out.itertuples():
        where[text[r.doc_id]].add(r.shard)
    assert max(map(len, where.values())) == 1


def test_hot_group_is_cut_over_shards(spark):
    rows = [(i, "same text again") for i in range(1500)] + [(5000 + i, f"text {i} other") for i in range(1500)]
    out = sharding.shard(documents(spark, rows), n_shards=6).toPandas()
    n = out.groupby("shard").size()
    assert len(n) == 6 and n.max() < 1.15 * n.mean()


def test_shards_of_odd_rows_and_of_nothing(spark):
    rows = odd_rows()
    out = sharding.shard(documents(spark, rows), n_shards=3).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
    assert {r["size"] for r in out if r.doc_id in (1, 2)} == {8}
    for s in {r.shard for r in out}:
        assert sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out)))
    assert sharding.shard(documents(spark, rows).limit(0)).count() == 0


def _targets(sizes, weights, cap):
    """Water filling, round by round."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > cap * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / total for s in free}
            break
        for s in over:
            target[s] = cap * sizes[s]
            left -= target[s]
        free -= over
    return target


def test_mix_meets_its_targets(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "w " * int(rng.integers(1, 9)), "en", None if i % 11 == 0 else f"s{min(i % 7, 4)}") for i in range(4000)]
    rows += [(9000 + i, "big one", "en", "rare") for i in range(3)]
    df = documents(spark, rows)
    out = mixing.mix(df).toPandas()
    size = {i: len(words(t)) for i, t, *_ in rows}
    source = {i: s for i, _, _, s in rows}
    sizes = Counter()
    for i in size:
        sizes[source[i]] += size[i]
    goal = _targets(sizes, (5, 2, 1), 3)
    taken = Counter()
    for r in out.itertuples():
        assert r.size == size[r.doc_id] and r.source_size == sizes[source[r.doc_id]]
        assert math.isclose(r.target, goal[source[r.doc_id]], rel_tol=1e-9)
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        taken[source[r.doc_id]] += r.taken
    for s in goal:
        assert abs(taken[s] - goal[s]) <= 9
    rows_out = mixing.mixed_rows(df)
    assert rows_out.columns == df.columns
    assert rows_out.select(*CLASHING).distinct().collect() == [("x",) * len(CLASHING)]
    assert rows_out.groupBy("doc_id").count().agg(F.sum("count")).first()[0] == out.copies.sum()
    assert sorted(map(str, mixing.mix(df).collect())) == sorted(map(str, mixing.mix(df.repartition(7)).collect()))


def test_mix_of_odd_rows_and_of_nothing(spark):
    out = mixing.mix(documents(spark, odd_rows()))
    assert out.count() == len(odd_rows())
    assert {r.taken for r in out.collect() if r.size == 0} == {0}
    empty = documents(spark, odd_rows()).limit(0)
    assert mixing.mix(empty).count() == 0 and mixing.mixed_rows(empty).count() == 0
    blank = mixing.mix(documents(spark, [(1, None), (2, "")])).collect()
    assert [(r.target, r.taken) for r in blank] == [(0.0, 0), (0.0, 0)]


def _top(rows, k):
    ok = [(i, v) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in ok if i % 20 == 0}):
        vec = min([[math.floor(64 * x) for x in v] for i, v in ok if i == q])
        scored = sorted((-sum(a * math.floor(64 * b) for a, b in zip(vec, v)), i) for i, v in ok if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return out


@pytest.mark.parametrize("n,k,blocks", [(300, 20, (4096, 512)), (500, 5, (37, 3)), (12, 20, (4, 1))])
def test_top_k_is_exact(spark, monkeypatch, n, k, blocks):
    monkeypatch.setattr(topk, "VECTORS_A_BLOCK", blocks[0])
    monkeypatch.setattr(topk, "QUERIES_A_BLOCK", blocks[1])
    monkeypatch.setattr(topk, "FAN", 4)
    rng = np.random.default_rng(n)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, 7)]) for i in range(n)]
    rows[5:60] = [(i, [0.25] * 7) for i in range(5, 60)] if n > 100 else rows[5:60]
    rows += [(None, [0.1] * 7), (n + 1, None), (n + 2, [0.1, None] + [0.0] * 5), (n + 3, [math.nan] * 7), (n + 4, [math.inf] + [0.0] * 6), (n + 5, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    df = df.select("*", F.lit(1).alias("id"), F.lit(2).alias("block"), F.lit(3).alias("best"))
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = [tuple(r) for r in topk.top_k(df, F.col("vec_id") % 20 == 0, k=k).orderBy("query_id", "rank").collect()]
    assert got == _top(rows, k)


def test_top_k_of_copies_and_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(topk, "VECTORS_A_BLOCK", 20)
    monkeypatch.setattr(topk, "QUERIES_A_BLOCK", 4)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 5)]) for i in range(150)]
    rows += [(i, [0.5] * 5) for i in range(150, 400)]                     # many copies, queries among them
    rows += [(20, [0.75] * 5)] * 40 + [(20, [0.75 + j / 64] * 5) for j in range(30)] + [(31, [0.75] * 5)] * 3
    rows += [(i, [300.0, -600.0, 1e6, 2.5e5, float(i)]) for i in range(500, 520)]      # beyond 16 bits
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = [tuple(r) for r in topk.top_k(df, F.col("vec_id") % 20 == 0, k=6).orderBy("query_id", "rank").collect()]
    assert got == _top(rows, 6)


def test_lists_send_only_entries_that_can_matter(spark):
    """The cutoff is reached by k rows and by no more than ties above the k-th; below its half nothing is sent or resolved."""
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").filter(F.col("embedding").isNotNull())
    lists = topk.Lists(vectors, F.col("vec_id") % 20 == 0, 20, "vec_id", "embedding", 64.0)
    cutoffs = lists.cutoffs()
    kth = {q: c for r in cutoffs.collect() for q, c in zip(r.cut_ids, r.cuts)}
    entries = lists.collected(cutoffs)
    sent = entries.join(lists.queries.filter("slice = 0").select("qblock", "q_lead"), "qblock").collect()
    n = vectors.count()
    assert len(kth) == vectors.filter("vec_id % 20 = 0").count() and {r.slice for r in sent} == set(range(topk.LISTS))
    for r in sent:
        ids = np.frombuffer(r.q_lead, np.int64)
        assert all(p * topk.LISTS >= kth[int(ids[q])] for q, p in zip(r.qpos, r.part))
    assert sum(len(r.part) for r in sent) < 0.2 * topk.LISTS * n * len(kth)
    best = {r.query_id: [-e.neg for e in r.best] for r in lists.resolved(entries, cutoffs).collect()}
    assert all(kth[q] <= scores[-1] and len(scores) == 20 for q, scores in best.items()) and best.keys() == kth.keys()


def test_top_k_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df, F.col("vec_id") % 20 == 0).count() == 0
    one = spark.createDataFrame([(1, [0.5])], "vec_id long, embedding array<float>")
    assert topk.top_k(one, F.col("vec_id") % 20 == 0).count() == 0


VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def _best(word, pieces, unknown):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        options = [(best[s][0] + pieces[word[s:end]], best[s][1] + 1) for s in range(end) if word[s:end] in pieces]
        if word[end - 1] not in pieces:
            options.append((best[end - 1][0] + unknown, best[end - 1][1] + len(word[end - 1].encode())))
        best.append(max(options, key=lambda x: x[0]))
    return best[-1][1]


def test_token_counts_equal_a_plain_search(spark):
    pieces = tokencount.read_pieces(VOCABULARY)
    unknown = min(pieces.values()) - tokencount.UNKNOWN_PENALTY
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r for r in tokencount.token_counts(docs, VOCABULARY).collect()}
    known = {}
    for r in docs.collect():
        w = r.text.split()
        for x in set(w) - known.keys():
            known[x] = _best(tokencount.MARK + x, pieces, unknown)
        assert (got[r.doc_id].n_words, got[r.doc_id].n_tokens) == (len(w), sum(known[x] for x in w))


def test_token_counts_equal_a_public_unigram_model():
    tokenizers = pytest.importorskip("tokenizers")
    pieces = tokencount.read_pieces(VOCABULARY)
    model = tokenizers.models.Unigram([("<unk>", 0.0), *pieces.items()], 0, False)
    texts = sorted({tokencount.MARK + w for w in "the quick thenonly ünïversal 12345 don't nonsenseword aaaa qqqqqqqqz straße".split()})
    longest = max(map(len, pieces))
    assert tokencount.trie_counts(texts, pieces, longest) == [len(model.tokenize(t)) for t in texts]


def test_pieces_of_a_unigram_file_keep_their_scores(tmp_path):
    sentencepiece = pytest.importorskip("sentencepiece")
    rng = np.random.default_rng(0)
    parts = ["an", "be", "ci", "de", "el", "fo", "ga", "he", "tion", "ing"]
    texts = [" ".join("".join(rng.choice(parts, 3)) for _ in range(20)) for _ in range(300)]
    for kind in ("unigram", "bpe"):
        sentencepiece.SentencePieceTrainer.train(sentence_iterator=iter(texts), model_prefix=str(tmp_path / kind), vocab_size=60,
                                                 model_type=kind, hard_vocab_limit=False, minloglevel=2)
    model = sentencepiece.SentencePieceProcessor(model_file=str(tmp_path / "unigram.model"))
    pieces = tokencount.read_pieces(str(tmp_path / "unigram.model"))
    assert len(pieces) > 20 and all(s == model.get_score(model.piece_to_id(p)) for p, s in pieces.items())
    words_ = sorted({tokencount.MARK + w for t in texts[:20] for w in t.split()})
    got = tokencount.trie_counts(words_, pieces, max(map(len, pieces)))
    assert got == [len(model.encode(w[1:])) for w in words_]
    ranks = tokencount.read_pieces(str(tmp_path / "bpe.model"))
    assert list(ranks.values()) == [-math.log(r + 10) for r in range(len(ranks))]


def test_token_counts_of_odd_rows(spark):
    out = tokencount.token_counts(documents(spark, odd_rows()), VOCABULARY).collect()
    assert len(out) == len(odd_rows())
    assert {(r.n_words, r.n_tokens) for r in out if r.doc_id in (1, 2, 3)} == {(0, 0)}
    assert len({r.n_tokens for r in out if r.doc_id == 4}) == 1
    assert tokencount.token_counts(documents(spark, []), VOCABULARY).count() == 0


@pytest.mark.parametrize("lump", [(7, "one row again and again"), (None, "no id here")])
def test_equal_rows_are_dealt_out_evenly(spark, lump):
    """A third of all rows are equal, with one id or none: shards stay even and slots gapless."""
    rng = np.random.default_rng(5)
    rows = [lump] * 4000 + [(100 + i, f"text {i} " + "w " * int(rng.integers(1, 4))) for i in range(8000)]
    out = sharding.shard(documents(spark, rows), n_shards=24).toPandas()
    sums = out.groupby("shard")["size"].sum()
    assert len(sums) == 24 and abs(sums / sums.mean() - 1).max() < 0.01
    for _, g in out.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))


@pytest.mark.parametrize("lump", [(7, "equal words " * 10), (None, "words without id " * 5)])
def test_equal_rows_are_mixed_in_part(spark, lump):
    """A source that is one lump of equal rows meets its target within one row, and reruns agree."""
    rows = [(*lump, "en", "a")] * 3000 + [(100 + i, "b words " * (1 + i % 9), "en", "b") for i in range(2000)] + [
        (9000 + i, "few words here", "en", "c") for i in range(1500)]
    df = documents(spark, rows).repartition(5)
    out = mixing.mix(df).toPandas()
    for _, g in out.groupby("source"):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= g["size"].max()
    part = out[out.source == "a"]
    assert 0 < (part.taken > part.taken.min()).sum() < len(part)
    again = mixing.mix(documents(spark, rows).repartition(3)).toPandas()
    key = ["source", "size", "taken"]
    assert out.groupby(key).size().equals(again.groupby(key).size())
    stored_df = documents(spark, rows)
    assert abs(mixing.mixed_rows(stored_df).filter("source = 'a'").count() * part["size"].iloc[0] - part.target.iloc[0]) <= part["size"].iloc[0]
