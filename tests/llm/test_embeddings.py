"""Near-duplicate embeddings and whitening against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tussock.llm import quantise, whiten
from tussock.llm.quantise import embedding_links
from tussock.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"
CLASHING = "id key label_ vec copies n step list own block i j other first_id least_id n_links x task component".split()


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).select("*", *(F.lit("x").alias(c) for c in CLASHING))


def brute_links(rows, least=0.93):
    """(id, links, smallest id reachable) by every pair."""
    def fine(v, label):
        return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    ok = [k for k, (_, v, label) in enumerate(rows) if fine(v, label)]
    dim = max((len(rows[k][1]) for k in ok), default=0)
    x = {k: np.array([np.float32(e) for e in rows[k][1]] + [0] * (dim - len(rows[k][1])), float) for k in ok}
    near = {k: set() for k in range(len(rows))}
    for n, a in enumerate(ok):
        for b in ok[:n]:
            if rows[a][2] == rows[b][2] and x[a] @ x[b] / np.sqrt(x[a] @ x[a]) / np.sqrt(x[b] @ x[b]) >= least:
                near[a].add(b)
                near[b].add(a)
    out = []
    for k in range(len(rows)):
        seen, todo = {k}, [k]
        while todo:
            for m in near[todo.pop()] - seen:
                seen.add(m)
                todo.append(m)
        ids = [rows[m][0] for m in seen if rows[m][0] is not None]
        out.append((rows[k][0], len(near[k]), min(ids) if ids else None))
    return out


def as_set(df):
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in df.collect()), key=str)


def planted(rng, centres, dim, noise, members):
    """Groups of near copies among random vectors."""
    rows = []
    for c in range(centres):
        v = rng.normal(size=dim)
        v /= np.linalg.norm(v)
        for _ in range(int(rng.integers(1, members))):
            w = v + noise(rng) * rng.normal(size=dim) / np.sqrt(dim)
            rows.append((len(rows), [float(e) for e in w * rng.uniform(0.1, 9)], c % 3))
    return rows


def test_links_equal_brute_force_with_many_lists(spark, monkeypatch):
    monkeypatch.setattr(quantise, "LIST_VECTORS", 20)
    rng = np.random.default_rng(1)
    rows = planted(rng, 150, 32, lambda r: r.uniform(0.05, 0.45), 9)
    want, got = brute_links(rows), as_set(embedding_links(frame(spark, rows)))
    links = sum(w[1] for w in want)
    assert sum(g[1] for g in got) >= 0.99 * links > 500
    best = {w[0]: w[1] for w in want}
    assert all(n <= best[i] for i, n, _ in got)


def test_dense_group_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(quantise, "LIST_VECTORS", 100)
    monkeypatch.setattr(quantise, "BLOCK", 32)
    rng = np.random.default_rng(2)
    centre = rng.normal(size=16)
    tight = [(i, [float(e) for e in centre + 0.3 * rng.normal(size=16)], 0) for i in range(300)]
    copies = [(1000 + i, [float(e) for e in centre], 0) for i in range(200)]
    other = [(2000 + i, [float(e) for e in rng.normal(size=16)], 0) for i in range(300)]
    rows = tight + copies + other
    got, want = as_set(embedding_links(frame(spark, rows))), sorted(brute_links(rows), key=str)
    assert sum(g[1] for g in got) >= 0.995 * sum(w[1] for w in want) > 100_000
    assert sum(g == w for g, w in zip(got, want)) >= 0.98 * len(want)


def test_one_list_is_exact(spark):
    rng = np.random.default_rng(3)
    rows = planted(rng, 60, 8, lambda r: r.uniform(0.0, 0.6), 8)
    assert as_set(embedding_links(frame(spark, rows))) == sorted(brute_links(rows), key=str)


def test_no_link_is_lost_between_codes_and_exact_vectors():
    """The table distance less the code's error never exceeds the true distance."""
    rng = np.random.default_rng(4)
    x = quantise.unit(rng.normal(size=(500, 10)))
    m = quantise.Model(x[:200], 4, 0.93)
    own, _, _ = m.assign(x)
    codes, miss = m.encode(x, own)
    for here in range(len(m.lists)):
        held = np.flatnonzero(own == here)
        far = sum(t[:, codes[held][:, s]] for s, t in enumerate(m.tables(x, here)))
        true = np.sqrt(((x[:, None] - x[held][None]) ** 2).sum(2))
        assert (np.sqrt(np.maximum(far, 0)) <= true + miss[held][None] + 1e-6).all()


def test_odd_vectors(spark):
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [1.0, None], 0), (5, [1.0, float("nan")], 0), (6, [1.0, float("inf")], 0),
            (7, [1.0, 0.0], None), (8, [1.0, 0.0], 0), (8, [1.0, 0.0], 0), (9, [2.0, 0.0], 0), (10, [1.0], 0), (11, [1.0, 0.0], 1),
            (None, [1.0, 0.001], 0), (None, [0.0, -1.0], 0), (12, [-0.0, 1.0], 2), (13, [0.0, 1.0], 2), (14, [-1.0, 0.0], 0)]
    out = embedding_links(frame(spark, rows))
    assert as_set(out) == sorted(brute_links(rows), key=str)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    kept = {r.vec_id: r.kept for r in out.collect() if r.vec_id is not None}
    assert kept[8] and not kept[9] and not kept[10] and kept[1] and kept[12] and not kept[13]


def test_empty_tables(spark):
    for rows in ([], [(1, None, 0), (2, [], 1)]):
        assert len(embedding_links(frame(spark, rows)).collect()) == len(rows)
        assert whiten.whiten(frame(spark, rows)).collect() == []


@pytest.mark.parametrize("dim,copies", [(5, 1), (20, 3)])
def test_whitening_equals_numpy(spark, dim, copies):
    rng = np.random.default_rng(dim)
    base = rng.normal(size=(200, dim)) @ rng.normal(size=(dim, dim))
    rows = [(k, [float(e) for e in base[k % 200]], 0) for k in range(200 * copies)]
    out = whiten.whiten(frame(spark, rows), components=16).toPandas()
    x = np.floor(64 * base.astype(np.float32).astype(float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    e, b = np.linalg.eigh(np.cov(fit.T, bias=True))
    e, b = e[::-1], b[:, ::-1]
    k = min(dim, 16)
    assert len(out) == len(rows) * k and (out.n == n).all()
    p = out.sort_values(["vec_id", "component"]).whitened.to_numpy().reshape(-1, k)
    q = (x - s / n) @ b[:, :k] / np.sqrt(e[:k])
    sign = np.sign((p[:200] * q).sum(0))
    assert np.allclose(p[:200] * sign, q, atol=1e-7)
    assert np.allclose(out.sort_values(["vec_id", "component"]).explained.to_numpy()[:k], (e / e.sum())[:k], rtol=1e-9)
    assert out.identity_error.max() < 1e-8
    exact = [sum((n * int(a) - int(c)) ** 2 for a, c in zip(r, s)) for r in x]
    assert out[out.component == 1].sort_values("vec_id").deviation.tolist() == exact * copies


def test_sums_of_squares_are_exact():
    rng = np.random.default_rng(0)
    d = rng.integers(-2 ** 46, 2 ** 46, size=(300, 4))
    sums = dict(zip(whiten.pair_order(4), whiten.exact(*whiten.squares(d))))
    for (i, j), s in sums.items():
        assert s == sum((int(r[i]) if i == j else int(r[i]) + int(r[j])) ** 2 for r in d)


def test_whitening_of_odd_vectors(spark):
    rows = [(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (2, None, 0), (3, [1.0, None], 0), (4, [float("inf"), 1.0], 0), (None, [3.0, 2.0], None),
            (5, [2.0], 0), (6, [], 0)]
    out = whiten.whiten(frame(spark, rows)).toPandas()
    assert sorted(out.vec_id.dropna().astype(int)) == [1] * 4 + [5] * 2 + [6] * 2 and out.vec_id.isna().sum() == 2
    assert (out.n == 4).all()
    same = whiten.whiten(frame(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)])).toPandas()
    assert len(same) == 4 and same.whitened.isna().all() and same.identity_error.isna().all() and (same.deviation == 0).all()


def test_queries_on_whole_tables(spark):
    links = QUERIES["op11_embedding_near_dedup"](spark, "/root/testdata/sf0.001")
    assert dict(links.dtypes) == {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"}
    white = QUERIES["op13_whitening"](spark, "/root/testdata/sf0.001")
    assert dict(white.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
                                  "explained": "double", "identity_error": "double"}
    assert white.agg(F.max("identity_error")).first()[0] < 1e-8 and links.count() == white.count() // 16
