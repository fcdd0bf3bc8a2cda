"""Language model, toxicity and html labeller: exact parts by brute force, learnt parts by held-out accuracy."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import documents, odd_rows, words
from tussock.llm import brown, html, toxicity

SF = "/root/testdata/sf0.001"
def fold():
    return F.crc32(F.col("doc_id").cast("string").cast("binary"))



def _check_base(rows, out, learnt):
    c, n_docs = Counter(), 0
    for i, t in rows:
        if learnt(i):
            c.update(words(t))
            n_docs += 1
    total, kinds = sum(c.values()) + n_docs, len(c) + (n_docs > 0)
    want = Counter()
    for i, t in rows:
        seen = [c[w] for w in words(t)] + [n_docs]
        base = sum(math.log10((x + 0.1) / (total + 0.1 * (kinds + 1))) for x in seen)
        want[i, not learnt(i), len(seen), sum(x > 0 for x in seen), total, round(base, 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == want


@pytest.mark.parametrize("lexicon", [400_000, 50])
def test_class_model_counts_exactly_and_beats_unigrams(spark, monkeypatch, lexicon):
    monkeypatch.setattr(brown, "LEXICON", lexicon)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    out = brown.class_scores(documents(spark, rows), fold() % 10 != 0).collect()
    _check_base(rows, out, lambda i: zlib.crc32(str(i).encode()) % 10 != 0)
    for held in (False, True):
        part = [r for r in out if r.held_out == held]
        assert sum(r.score for r in part) > sum(r.base_score for r in part)
    assert all(r.score < 0 for r in out)


def test_class_model_splits_texts_into_words_twice(spark, monkeypatch):
    """To count the words and to code them; all sweeps and the scores read the codes."""
    from tussock.llm import store

    kept = {}

    def noted(df, name):
        out = store.stored(df, name)
        kept.setdefault(name, []).append(df._jdf.queryExecution().optimizedPlan().toString())
        return out

    monkeypatch.setattr(brown, "stored", noted)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    brown.class_scores(documents(spark, rows), F.col("doc_id") % 10 != 0, lexicon=50, own_count=4)
    assert sorted(name for name, plans in kept.items() if any("text" in p for p in plans)) == ["lm-coded", "lm-words"]
    assert {"lm-pairs", "lm-moved", "lm-open", "lm-scored"} <= set(kept)


def test_class_model_of_odd_rows(spark):
    rows = [r[:2] for r in odd_rows()]
    out = brown.class_scores(documents(spark, rows), fold() % 10 != 0).collect()
    _check_base(rows, out, lambda i: i is None or zlib.crc32(str(i).encode()) % 10 != 0)
    assert brown.class_scores(documents(spark, []), fold() % 10 != 0).count() == 0
    unseen = brown.class_scores(documents(spark, rows), F.lit(False)).collect()
    assert {(r.n_known, r.train_tokens) for r in unseen} == {(0, 0)}
    assert all(math.isfinite(r.score) for r in unseen)


def test_exchange_finds_the_classes_of_a_made_language():
    rng = np.random.default_rng(0)
    n, kinds = 41, 4
    of = np.append(np.arange(n - 1) % kinds, -1)
    pairs = np.zeros((n, n))
    for _ in range(20000):
        a = int(rng.integers(0, n - 1))
        nxt = rng.choice(np.flatnonzero(of == (of[a] + 1) % kinds))
        pairs[a, nxt] += 1
    label = brown.exchange(pairs, classes=kinds + 1, sweeps=20)
    assert len({(of[i], label[i]) for i in range(n - 1)}) == kinds and label[-1] == 0


def test_best_classes_are_those_of_the_exchange_step():
    rng = np.random.default_rng(3)
    n, k = 30, 5
    pairs, label = rng.poisson(2, (n, n)).astype(float) * rng.integers(0, 2, (n, n)), rng.integers(1, k, n)

    def likelihood(of):
        member = np.eye(k)[of]
        return brown.likelihood(member.T @ pairs @ member)

    member = np.eye(k)[label]
    full = np.concatenate([pairs @ member, (member.T @ pairs).T, np.diagonal(pairs)[:, None]], axis=1)
    at, slot = np.nonzero(full)
    got = brown.best_classes(member.T @ pairs @ member, label, at, slot, full[at, slot])
    for w in range(n):
        want = [likelihood(np.where(np.arange(n) == w, c, label)) for c in range(1, k)]
        assert math.isclose(want[got[w] - 1], max(want), rel_tol=1e-12)


def test_words_beyond_the_most_frequent_get_their_own_class(spark):
    rng = np.random.default_rng(5)
    kinds = 4
    names = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 7)) for _ in range(4000)]
    rows = []
    for i in range(1200):
        at = int(rng.integers(kinds))
        rows.append((i, " ".join(names[kinds * int(rng.integers(len(names) // kinds)) + (at + p) % kinds] for p in range(120))))
    out = brown.class_scores(documents(spark, rows), F.col("doc_id") % 10 != 0).filter("held_out").collect()
    gain = sum(r.score - r.base_score for r in out) / sum(r.n_tokens for r in out)
    assert gain > 0.5


def _plain_scores(texts, learnt, lexicon, top_words, own_count):
    """log10 probability of each text by plain loops, and the words placed beyond the lexicon, from exchange and best_classes."""
    split = [words(t) for t in texts]
    counts = Counter(w for s, l in zip(split, learnt) if l for w in s)
    vocabulary = sorted({w for s in split for w in s})
    raw = [w.encode() for w in vocabulary]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    _, hashes, endings = brown.tokens(brown.Hasher(), np.frombuffer(b"".join(raw), np.uint8), offsets)
    key, ending = dict(zip(vocabulary, hashes.tolist())), dict(zip(vocabulary, endings.tolist()))
    levels = {w: math.floor(math.log(c) / math.log(2) * 16) for w, c in counts.items()}
    cut = min((l for l in levels.values() if sum(x >= l for x in levels.values()) <= lexicon), default=math.inf)
    near = sorted((w for w in counts if levels[w] >= cut), key=lambda w: (-counts[w], key[w]))
    rank = {w: i for i, w in enumerate(near[:top_words])}
    kind = {w: rank.get(w, ending[w]) for w in vocabulary}
    kind[None] = brown.END_TYPE
    bigrams = Counter(p for s, l in zip(split, learnt) if l for p in zip([None, *s], [*s, None]))
    pairs = np.zeros((brown.TYPES, brown.TYPES))
    for (a, b), n in bigrams.items():
        pairs[kind[a], kind[b]] += n
    label = brown.exchange(pairs)
    of = {w: int(label[k]) for w, k in kind.items()}

    def table(of):
        out = np.zeros((brown.CLASSES, brown.CLASSES))
        for (a, b), n in bigrams.items():
            out[of[a], of[b]] += n
        return out

    def swept(of, movers):
        movers = sorted(movers, key=key.get)
        place = {w: i for i, w in enumerate(movers)}
        full = np.zeros((len(movers), brown.SLOTS))
        for (a, b), n in bigrams.items():
            if a in place:
                full[place[a], of[b]] += n
                full[place[a], 2 * brown.CLASSES] += n * (a == b)
            if b in place:
                full[place[b], brown.CLASSES + of[a]] += n
        at, slot = np.nonzero(full)
        new = brown.best_classes(table(of), np.array([of[w] for w in movers], int), at, slot, full[at, slot])
        return {**of, **dict(zip(movers, new.tolist()))}

    for _ in range(brown.WORD_SWEEPS):
        new = swept(of, [w for w in near[top_words:] if counts[w] >= own_count])
        if brown.likelihood(table(new)) <= brown.likelihood(table(of)):
            break
        of = new
    far = [w for w in counts if levels[w] < cut and counts[w] >= own_count]
    new = swept(of, far)
    moved = {w for w in far if new[w] != of[w]} if brown.likelihood(table(new)) > brown.likelihood(table(of)) else set()
    of = new if moved else of
    step = table(of)
    size, kinds = np.zeros(brown.CLASSES), np.zeros(brown.CLASSES)
    for w, c in counts.items():
        size[of[w]] += c
        kinds[of[w]] += 1
    share = (step.sum(0) + 1) / (step.sum() + brown.CLASSES)
    step = (step + brown.PRIOR * share) / (step.sum(1, keepdims=True) + brown.PRIOR)
    scores = [sum(math.log10(step[of[a], of[b]]) for a, b in zip([None, *s], [*s, None]))
              + sum(math.log10((counts[w] + 0.1) / (size[of[w]] + 0.1 * (kinds[of[w]] + 1))) for w in s) for s in split]
    together = sum(n for (a, b), n in bigrams.items() if a in moved and b in moved)
    return scores, moved, together


@pytest.mark.parametrize("lexicon", [100_000, 300])
def test_class_scores_equal_a_plain_computation(spark, lexicon):
    rng = np.random.default_rng(11)
    names = ["".join(rng.choice(list("abcdefghij"), int(rng.integers(2, 7)))) for _ in range(1500)]
    rows = []
    for i in range(300):
        at = int(rng.integers(3))
        rows.append((i, " ".join(names[3 * min(499, int(rng.exponential(120))) + (at + p) % 3] for p in range(int(rng.integers(0, 150))))))
    rows += [(300, None), (301, names[3] + " unseen " + names[1400] + " " + names[1400])]
    learnt = [i % 10 != 0 for i, _ in rows]
    want, moved, together = _plain_scores([t for _, t in rows], learnt, lexicon, 100, 4)
    assert (len(moved) > 50 and together > 10) == (lexicon == 300)
    out = brown.class_scores(documents(spark, rows), F.col("doc_id") % 10 != 0, lexicon=lexicon, top_words=100, own_count=4)
    got = {r.doc_id: r.score for r in out.collect()}
    assert len(got) == len(rows)
    assert all(math.isclose(got[i], w, rel_tol=1e-9, abs_tol=1e-9) for (i, _), w in zip(rows, want))


TOXIC = ["grumbolt", "snarvik", "plodder", "vexnar"]


def _toxic_rows(n, seed):
    rng = np.random.default_rng(seed)
    plain = ["".join(rng.choice(list("aeioulmnrst"), int(rng.integers(2, 9)))) for _ in range(2000)]
    rows, labels = [], []
    for i in range(n):
        w = list(rng.choice(plain, int(rng.integers(10, 120))))
        y = int(i % 5 == 0)
        if y:
            for _ in range(2):
                w.insert(int(rng.integers(0, len(w))), str(rng.choice(TOXIC)) + str(rng.choice(["", "!", "ish", "ed,", "s"])))
        rows.append((i, " ".join(w), ["en", "fr", None][i % 3]))
        labels.append((i, 1, y))
    return rows, labels


def test_classifier_separates_held_out_texts(spark):
    rows, labels = _toxic_rows(900, 1)
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in toxicity.score(documents(spark, rows), labelled, usable=fold() % 4 != 2, keep=("lang",)).collect()}
    held = [i for i, *_ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    right = [(out[i].score >= 0.3) == (i % 5 == 0) for i in held]
    assert len(held) > 100 and np.mean(right) > 0.97
    assert np.mean([out[i].rejected == (i % 5 == 0) for i in held]) > 0.97
    assert out[3].lang == rows[3][2] and all(0 <= r.score <= 1 for r in out.values())


def test_an_id_that_repeats_is_learnt_once(spark, monkeypatch):
    rows, labels = _toxic_rows(60, 4)
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    columns = (None, "doc_id", "text", "toxic", "lang", toxicity.TRAIN_ROWS)
    once = toxicity.sample(documents(spark, rows), labelled, *columns).count()
    hot = rows + [(5, f"copy {i} of a hot id", "en") for i in range(300)] + [rows[7]] * 300
    assert once == toxicity.sample(documents(spark, hot), labelled, *columns).count() == 60


def test_every_labelled_row_is_learnt_from(spark):
    """Whatever their number, and whole long texts: label 1 is seen in texts of over 64 KB alone."""
    rows, labels = _toxic_rows(150, 5)
    rows = [(i, t + " plain words" * 6000 if y else t, lang) for (i, t, lang), (_, _, y) in zip(rows, labels)]
    more = [(1000 + i, f"number {i}", "en") for i in range(3200)]
    labelled = spark.createDataFrame([*labels, *((i, 1, 0) for i, *_ in more)], "doc_id long, quality int, toxic int")
    docs = documents(spark, rows + more)
    columns = (None, "doc_id", "text", "toxic", "lang", toxicity.TRAIN_ROWS)
    assert toxicity.sample(docs, labelled, *columns).count() == len(rows) + len(more)
    out = {r.doc_id: r.score >= 0.3 for r in toxicity.score(docs, labelled).collect()}
    assert np.mean([out[i] for i, _, y in labels if y]) > 0.9 and not any(out[i] for i, *_ in more)


@pytest.mark.parametrize("part", [20_000, 60_000])
def test_parts_learnt_apart_separate_texts_too(spark, monkeypatch, part):
    monkeypatch.setattr(toxicity, "PART_BYTES", part)
    rows, labels = _toxic_rows(900, 1)
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = documents(spark, rows)
    out = {r.doc_id: r.score for r in toxicity.score(docs, labelled, usable=fold() % 4 != 2).collect()}
    held = [i for i, *_ in rows if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(out[i] >= 0.3) == (i % 5 == 0) for i in held]) > 0.97
    assert out == {r.doc_id: r.score for r in toxicity.score(docs, labelled, usable=fold() % 4 != 2).collect()}


def test_scores_depend_on_the_text_alone(spark):
    rows, labels = _toxic_rows(300, 2)
    labelled = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    docs = documents(spark, rows)
    first = {r.doc_id: r.score for r in toxicity.score(docs, labelled).collect()}
    other = docs.withColumn("lang", F.lit("de")).withColumn("source", F.lit("z"))
    again = {r.doc_id: r.score for r in toxicity.score(other, labelled).collect()}
    assert first == again


def test_classifier_on_odd_rows_and_without_labels(spark):
    rows, labels = _toxic_rows(100, 3)
    odd = [(None if r[0] is None else r[0] + 1000, *r[1:]) for r in odd_rows()]
    labelled = spark.createDataFrame([*labels, (None, 1, 1), (1, 1, None), (2, 1, 1), (2, 1, 0)], "doc_id long, quality int, toxic int")
    docs = documents(spark, rows + odd)
    own = [c for c in docs.columns if c not in ("score", "threshold", "rejected")]
    out = toxicity.score(docs, labelled, keep=tuple(own))
    assert out.count() == len(rows) + len(odd) and out.columns == [*own, "score", "threshold", "rejected"]
    assert toxicity.score(docs.limit(0), labelled).count() == 0
    clean = toxicity.clean_rows(docs, labelled)
    assert clean.columns == docs.columns and clean.count() == out.filter("not rejected").count()
    assert {r.score for r in clean.collect()} == {"x"}
    none = toxicity.score(docs, labelled.limit(0)).collect()
    assert {r.rejected for r in none} == {False}


PAGES = [
    (1, "u1", "<html><head><title>No</title><script>var a='<p>x</p>'</script></head><body><nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul></nav>"
              "<article><h1>A  title &amp;\n more</h1><p>First <b>bold</b> part.<br>Second&nbsp;line.<p>Third paragraph, which is open.</article>"
              "<footer>&copy; 2020 Some firm. All rights.</footer></body></html>"),
    (2, "u2", None), (3, None, ""), (None, "u4", "plain text without any markup"), (5, "u5", "<article><p>unclosed <b>tags everywhere in this sentence."),
    (5, "u5", "<article><p>unclosed <b>tags everywhere in this sentence."), (6, "u6", "<!-- only a comment"), (7, "u7", "<p a='>' b=\">\">x < y and y > z"),
]


def test_blocks_of_a_page():
    got = [t for _, t, _ in html.blocks(PAGES[0][2])]
    assert got == ["Home", "News", "A title & more", "First bold part. Second line.", "Third paragraph, which is open.", "© 2020 Some firm. All rights."]
    assert [t for _, t, _ in html.blocks(PAGES[7][2])] == ["x < y and y > z"]
    assert html.blocks("") == [] and html.blocks("<!-- x") == []
    paths = [p for p, _, _ in html.blocks('<div class="site-nav topBar" id=x><table><tr><td>a<td>b</table></div>')]
    assert paths[0] == ("div", ".site", ".nav", ".top", ".bar", ".x", "table", "tr", "td") and paths[1] == paths[0]


@pytest.mark.parametrize("page", [
    "<head><title>t</title><body><article><p>Real text.</p></article>",
    "<head><meta charset=utf-8><title>t</title><p>Real text.</p><script>var s = '</head>'</script>",
    "<article><svg-icon></svg-icon><p>Real text.</p></article>",
    "<article><template-x>Real <object-x>text.</object-x></template-x></article>",
    "<svg width=1/><p>Real text.</p>",
    "<svg width=1/><p>Real text.</p><svg><text>No</text></svg>",
    "<article><object data=x><p>Real text.</p></article>",
    "<article><object data=x><p>Real text.</p><object>No</object></article>",
    "<article><iframe src=x><p>Real text.</p><iframe>No</iframe></article>",
    "<article><noscript><p>Real text.</p></article>",
    "<svg><title/><svg><title>No</title></svg>No</svg><p>Real text.</p><svg><title>No</title></svg>",
    "<script>document.write('<script>No</p>')</script><p>Real text.</p><iframe srcdoc='<p>No'></iframe>",
    "<textarea>No <script> no</textarea><p>Real text.</p><script>No</script>",
])
def test_raw_elements_take_no_text_behind_them(page):
    assert [t for _, t, _ in html.blocks(page)] == ["Real text."]


def test_many_open_raw_elements_take_linear_time():
    page = "<iframe><svg><script>" * 20000 + "<p>Real text.</p>"
    assert [t for _, t, _ in html.blocks(page)] == ["Real text."]


def test_main_text_of_odd_pages(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("text", F.lit("x")).withColumn("n_chars", F.lit(1))
    out = html.main_text(df).collect()
    assert Counter((r.page_id, r.url) for r in out) == Counter(p[:2] for p in PAGES)
    first = next(r for r in out if r.page_id == 1)
    assert first.text == "A title & more\nFirst bold part. Second line.\nThird paragraph, which is open."
    assert all(r.n_chars == len(r.text) for r in out)
    assert {r.text for r in out if r.page_id in (2, 3, 6)} == {""}
    assert html.main_text(df.limit(0)).count() == 0


def test_labeller_on_unseen_layouts_and_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    net = html.Labeller(np.random.default_rng(0))
    net.p = html.train(pages, "html")
    rng, right, n = np.random.default_rng(99), 0, 0
    made = [html.made_page(rng) for _ in range(150)]
    for got, (_, labels) in zip(html.label_pages(net, [html.blocks(p) for p, _ in made]), made):
        right, n = right + int((got == np.array(labels, bool)).sum()), n + len(labels)
    assert right / n > 0.98
    for r in html.main_text(pages).limit(50).collect():
        found = html.blocks(pages.filter(F.col("page_id") == r.page_id).first().html) if r.page_id < 5 else None
        if found:
            assert r.text == "\n".join(t for (_, t, _), y in zip(found, html.marked(found)) if y)


def test_gradients_of_the_labeller():
    rng = np.random.default_rng(1)
    net = html.Labeller(rng)
    x, mask = html.padded([rng.normal(0, 1, (4, html.INPUT)), rng.normal(0, 1, (2, html.INPUT))])
    y = rng.integers(0, 2, mask.shape)

    def loss():
        p = net.forward(x, mask)
        return -(np.where(mask, y * np.log(p) + (1 - y) * np.log(1 - p), 0)).sum() / mask.sum()

    grads = net.gradients(x, mask, y)
    for name, g in grads.items():
        at = tuple(int(rng.integers(0, s)) for s in g.shape)
        net.p[name][at] += 1e-5
        up = loss()
        net.p[name][at] -= 2e-5
        assert math.isclose((up - loss()) / 2e-5, g[at], rel_tol=1e-3, abs_tol=1e-7)
        net.p[name][at] += 1e-5


def test_scores_equal_a_plain_forward_pass():
    """The packed form (filters folded into the word table) against the filters applied token by token."""
    rng = np.random.default_rng(4)
    net = toxicity.Network(rng)
    net.bias[:] = rng.normal(0, 0.1, net.bias.shape)
    sizes = [0, 1, 2, 7, 0, 30]
    first = np.concatenate([[0], np.cumsum(sizes)])
    ids = rng.integers(0, toxicity.BUCKETS, (toxicity.VIEWS, first[-1]))
    got = toxicity.scores(net.tables(), first, ids)
    for a, b, score in zip(first, first[1:], got):
        z = net.out_bias
        for k, w in enumerate(toxicity.WIDTHS):
            for f in range(toxicity.FILTERS):
                sums = [sum(float(net.words[ids[v, t + j]] @ net.filters[w][j][:, f])
                            for j in range(w) if t + j < b for v in range(toxicity.VIEWS)) for t in range(a, b)]
                z += max(max(sums) + net.bias[k, f], 0) * net.out[k, f] if sums else 0
        assert math.isclose(score, 1 / (1 + math.exp(-z)), rel_tol=1e-5)


def test_labeller_equals_a_plain_recurrence():
    """Batched and padded pages against one page at a time, one block at a time."""
    rng = np.random.default_rng(3)
    net, n = html.Labeller(rng), html.HIDDEN
    pages = [rng.normal(0, 1, (size, html.INPUT)) for size in (1, 6, 3)]
    got = net.forward(*html.padded(pages))

    def sigmoid(x):
        return 1 / (1 + np.exp(-x))

    for page, probs in zip(pages, got):
        states = {}
        for d, order in (("f", range(len(page))), ("b", range(len(page) - 1, -1, -1))):
            h, c = np.zeros(n), np.zeros(n)
            for t in order:
                g = page[t] @ net.p["x" + d] + h @ net.p["h" + d] + net.p["c" + d]
                c = sigmoid(g[n:2 * n]) * c + sigmoid(g[:n]) * np.tanh(g[3 * n:])
                h = sigmoid(g[2 * n:3 * n]) * np.tanh(c)
                states[d, t] = h
        for t in range(len(page)):
            z = np.concatenate([states["f", t], states["b", t]]) @ net.p["o"] + net.p["z"][0]
            assert math.isclose(probs[t], sigmoid(z), rel_tol=1e-9)
