"""Posting lists and sorted passes against brute force."""

import math

import numpy as np
import pytest

from shopscope.llm import posting_lists as pl
from shopscope.llm import sorted_passes as sp
from shopscope.llm.shared import importable, shared_dir

SCHEMA = "vec_id long, embedding array<float>, label int, name string, score double"


@pytest.fixture()
def vectors(spark):
    shared_dir(spark)
    importable(spark)

    def make(rows):
        return spark.createDataFrame([(i, v, 0, "clash", 0.0) for i, v in rows], SCHEMA).repartition(3)

    return make


def _rows(seed=0, n=400, dim=16):
    """Random vectors, a dense group, exact copies, vectors that take no part, a null id."""
    rng = np.random.default_rng(seed)
    base = rng.standard_normal(dim)
    rows = [(i, rng.standard_normal(dim)) for i in range(n)]
    rows += [(n + i, base + 0.08 * rng.standard_normal(dim)) for i in range(150)]
    rows += [(n + 200 + i, rows[3][1]) for i in range(40)] + [(7, rows[7][1]), (None, rows[3][1])]
    rows = [(i, np.asarray(v, dtype=np.float32).tolist()) for i, v in rows]
    return rows + [(9000, None), (9020, [0.0] * dim), (9040, [math.nan] + [1.0] * (dim - 1)), (9060, [math.inf] + [1.0] * (dim - 1)), (9080, []), (9100, [None] + [1.0] * (dim - 1))]


def _good(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def _links(rows, cosine):
    good = [i for i, (_, v) in enumerate(rows) if _good(v)]
    x = np.array([rows[i][1] for i in good], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1)[:, None]
    hit = x @ x.T >= cosine
    np.fill_diagonal(hit, False)
    label = list(range(len(rows)))
    for a, b in zip(*np.nonzero(hit)):
        ra, rb = label[good[a]], label[good[b]]
        if ra != rb:
            label = [min(ra, rb) if c in (ra, rb) else c for c in label]
    n = dict(zip(good, hit.sum(1).tolist()))
    out = []
    for i, (vec, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        component = min(ids) if ids else None
        out.append((vec, n.get(i, 0), component, vec == component))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [2000, 30])
def test_sorted_passes_equal_all_pairs(vectors, monkeypatch, block):
    monkeypatch.setattr(sp, "BLOCK", block)
    rows = _rows()
    got = sorted((tuple(r) for r in sp.near_vectors(vectors(rows)).select("vec_id", "n_links", "component_id", "kept").collect()), key=str)
    assert got == _links(rows, 0.95)


def test_sorted_passes_empty_and_unusable(vectors):
    assert sp.near_vectors(vectors([])).count() == 0
    got = [tuple(r) for r in sp.near_vectors(vectors([(5, None), (None, [0.0, 0.0])])).collect()]
    assert sorted(got, key=str) == [(5, 0, 5, True), (None, 0, None, True)]


def test_passes_follow_the_number_of_vectors():
    assert 4 <= sp.passes_for(100) < sp.passes_for(10_000) < sp.passes_for(10**9)


def _nearest(rows, k):
    good = [(i, n) for n, (i, v) in enumerate(rows) if _good(v)]
    out = []
    for i, n in good:
        if i is None or i % 20:
            continue
        q = np.array(rows[n][1], dtype=np.float64)
        s = [(-float((q * np.array(rows[m][1], dtype=np.float64)).sum()), j is None, j or 0, j) for j, m in good if m != n]
        out += [(i, r + 1, j, -d) for r, (d, _, _, j) in enumerate(sorted(s)[:k])]
    return out


def test_nearest_is_exact_where_all_lists_are_searched(vectors):
    rows = _rows(1)
    got = sorted(tuple(r) for r in pl.nearest(vectors(rows), lambda c: c % 20 == 0).select("query_id", "rank", "vec_id", "score").collect())
    want = sorted(_nearest(rows, 20), key=lambda r: r[:2])
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], rtol=0, atol=1e-12)
    assert sum(a[2] == b[2] for a, b in zip(got, want)) >= 0.99 * len(want)


def test_nearest_recall_with_pruned_lists(vectors, monkeypatch):
    monkeypatch.setattr(pl, "LIST_SIZE", 16)
    monkeypatch.setattr(pl, "LIST_ROWS", 20)
    monkeypatch.setattr(pl, "QUERY_ROWS", 10)
    monkeypatch.setattr(pl, "SEARCH_LISTS", 40)
    rng = np.random.default_rng(3)
    rows = [(i, (rng.standard_normal(16) * rng.uniform(0.5, 2)).astype(np.float32).tolist()) for i in range(2000)]
    got = {(r.query_id, r.vec_id) for r in pl.nearest(vectors(rows), lambda c: c % 20 == 0).collect()}
    want = {(q, v) for q, _, v, _ in _nearest(rows, 20)}
    assert len(got) == len(want) and len(got & want) >= 0.9 * len(want)


def test_nearest_recall_does_not_fall_with_the_number_of_lists(vectors, monkeypatch):
    monkeypatch.setattr(pl, "LIST_SIZE", 8)
    monkeypatch.setattr(pl, "SEARCH_LISTS", 8)
    monkeypatch.setattr(pl, "LEAST_LISTS", 4)
    monkeypatch.setattr(pl, "BEAM", 12)
    rng = np.random.default_rng(5)
    rows = [(i, v) for i, v in enumerate((lambda x: x / np.linalg.norm(x, axis=1)[:, None])(rng.standard_normal((3000, 32))).astype(np.float32).tolist())]
    got = {(r.query_id, r.vec_id) for r in pl.nearest(vectors(rows), lambda c: c % 20 == 0).collect()}
    want = {(q, v) for q, _, v, _ in _nearest(rows, 20)}
    assert len(got) == len(want) and len(got & want) >= 0.93 * len(want)


def test_nearest_few_rows(vectors):
    assert pl.nearest(vectors([]), lambda c: c % 20 == 0).count() == 0
    got = [tuple(r) for r in pl.nearest(vectors([(0, [1.0, 0.0]), (1, [0.5, 0.0]), (2, [1.0, 0.0, 0.0]), (3, [2.0, 1.0])]), lambda c: c % 20 == 0).collect()]
    assert sorted(got) == [(0, 1, 3, 2.0), (0, 2, 1, 0.5)]


def test_graph_walk_finds_the_nearest_centroids():
    rng = np.random.default_rng(2)
    c = rng.standard_normal((3000, 8)).astype(np.float32)
    q = rng.standard_normal((50, 8)).astype(np.float32)
    got, d = pl.CentroidGraph(c).search(q, 10)
    want = np.argsort(((q[:, None] - c) ** 2).sum(2), axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) for a, b in zip(got.tolist(), want.tolist())]) >= 9
    assert (np.diff(d, axis=1) >= -1e-4).all()


def _crowd(n, pairs, dim=64, near=0.9, cosine=0.955):
    """Vectors of one topic that don't link, and among them pairs that do."""
    rng = np.random.default_rng(4)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    centre = unit(rng.standard_normal(dim))
    x = unit(rng.standard_normal((n, dim)))
    x = math.sqrt(near) * centre + math.sqrt(1 - near) * unit(x - (x @ centre)[:, None] * centre)
    side = unit(rng.standard_normal((pairs, dim)))
    side = unit(side - (side * x[:pairs]).sum(1)[:, None] * x[:pairs])
    return np.concatenate([x, cosine * x[:pairs] + math.sqrt(1 - cosine * cosine) * side])


def test_sorted_passes_find_pairs_in_a_crowd(vectors):
    rows = [(i, v) for i, v in enumerate(_crowd(2500, 200).astype(np.float32).tolist())]
    got = sorted((tuple(r) for r in sp.near_vectors(vectors(rows)).select("vec_id", "n_links", "component_id", "kept").collect()), key=str)
    want = _links(rows, 0.95)
    assert sum(r[1] > 0 for r in want) >= 400 and got == want


def test_nearest_asks_every_dimension(vectors):
    """200 vectors of 8 and 100 of 4 dimensions: all 15 queries have their neighbours, of their own dimension."""
    rng = np.random.default_rng(12)
    rows = [(i, rng.standard_normal(8 if i < 200 else 4).astype(np.float32).tolist()) for i in range(300)]
    got = {}
    for r in pl.nearest(vectors(rows), lambda c: c % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert sorted(got) == list(range(0, 300, 20))
    for q, found in got.items():
        group = [(i, v) for i, v in rows if len(v) == len(rows[q][1]) and i != q]
        best = sorted(group, key=lambda r: (-float(np.dot(np.float64(rows[q][1]), np.float64(r[1]))), r[0]))[:20]
        assert [v for _, v in sorted(found)] == [i for i, _ in best]


@pytest.mark.parametrize("length", [1e200, 1e20, 1e4, 1e-200])
def test_one_vector_of_another_length_changes_nothing_for_the_others(spark, length):
    """Float64 components, one vector very long (or short): every query is answered, and rightly."""
    rng = np.random.default_rng(13)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(200)]
    rows[7] = (7, (np.array(rows[7][1]) * length).tolist())
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for r in pl.nearest(frame, lambda c: c % 20 == 0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    hits = 0
    for q in range(0, 200, 20):
        best = sorted((r for r in rows if r[0] != q), key=lambda r: (-float(np.dot(rows[q][1], r[1])), r[0]))[:20]
        hits += len({v for _, v in got[q]} & {i for i, _ in best})
        assert len(got[q]) == 20
    assert hits >= 0.99 * 200


def test_lengths_of_many_sizes(spark, monkeypatch):
    """Lengths over 40 powers of ten: several ranges, recall as ever."""
    rng = np.random.default_rng(14)
    rows = [(i, (rng.standard_normal(8) * 10.0 ** rng.exponential(1.5)).tolist()) for i in range(4000)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    x = np.array([v for _, v in rows])
    got = {}
    for r in pl.nearest(frame, lambda c: c % 400 == 0, 10).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = 0
    for q in range(0, 4000, 400):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(got[q] & set(np.argsort(-s)[:10].tolist()))
    assert hits >= 0.9 * 100


def test_the_walk_reaches_every_centroid():
    """Two far groups of centroids: a wide walk meets all, whatever the entries."""
    rng = np.random.default_rng(15)
    c = np.concatenate([rng.standard_normal((60, 8)), 1000 + rng.standard_normal((60, 8))]).astype(np.float32)
    graph = pl.CentroidGraph(c)
    graph.entries = graph.entries[graph.entries < 60]
    got, d = graph.search(c[:5], 120)
    assert all(sorted(r) == list(range(120)) for r in got.tolist()) and np.isfinite(d).all()
