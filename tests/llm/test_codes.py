"""Vector code compression against a plain recomputation with Python integers."""

import math

import numpy as np
import pyarrow as pa
import pytest

from shopscope.llm import vector_codes as vc
from shopscope.llm.shared import importable, shared_dir

SCHEMA = "vec_id long, embedding array<double>, label string, code string, error string"


@pytest.fixture()
def vectors(spark):
    shared_dir(spark)
    importable(spark)
    return lambda rows, kind="double": spark.createDataFrame([(i, v, label, "clash", "x") for i, v, label in rows], SCHEMA.replace("double", kind)).repartition(3)


def _plain(rows, parts, entries, rounds):
    kept = [(i, v) for i, v, _ in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = -(-max([len(v) for _, v in kept] + [1]) // parts) * parts
    d = width // parts
    full = [(i, [int(x * 256 // 1) if abs(x) < 2 ** 53 else int(x) * 256 for x in v] + [0] * (width - len(v))) for i, v in kept]
    full.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = [[v[p * d:(p + 1) * d] for p in range(parts)] for _, v in full]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for r in range(rounds + 1):
        codes = [[min(range(len(books[p])), key=lambda e: (square(c[p], books[p][e]), e)) for p in range(parts)] for c in cut]
        if r < rounds:
            for p in range(parts):
                new = list(books[p])
                for e in range(len(new)):
                    own = [c[p] for c, k in zip(cut, codes) if k[p] == e]
                    if own:
                        new[e] = [sum(x) // len(own) for x in zip(*own)]
                books[p] = new
    errors = [sum(square(c[p], books[p][k[p]]) for p in range(parts)) for c, k in zip(cut, codes)]
    return sorted([(i, bytes(k).hex(), min(e, 2 ** 63 - 1)) for (i, _), k, e in zip(full, codes, errors)], key=str), books


def _rows(n=300, dim=8, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, dim))
    rows = [(int(i), (centres[i % 6] + 0.3 * rng.standard_normal(dim)).tolist(), "ab"[i % 2]) for i in rng.permutation(n)]
    rows += [(n + i, rows[0][1], None) for i in range(40)]  # copies
    rows += [(n + 100, [0.0] * dim, "a"), (None, rows[5][1], None), (3, rows[9][1], "b")]
    return rows + [(9000, None, "a"), (9001, [math.nan] + [1.0] * (dim - 1), "a"), (9002, [math.inf] + [1.0] * (dim - 1), None), (9003, [None] + [1.0] * (dim - 1), "b")]


def _got(frame, **kw):
    df, books = vc.compressed(frame, "label", **kw)
    return sorted([(r.vec_id, bytes(r.code).hex(), r.error) for r in df.collect()], key=str), books


@pytest.mark.parametrize("entries,rounds", [(16, 2), (5, 4), (1, 1)])
def test_codes_books_and_errors(vectors, entries, rounds):
    rows = _rows()
    assert _got(vectors(rows), parts=4, entries=entries, rounds=rounds) == _plain(rows, 4, entries, rounds)


def test_odd_lengths_huge_components_and_few_rows(vectors):
    rows = [(1, [0.5, -0.25, 7.0], "a"), (2, [1e200, 1.0], "a"), (3, [], None), (4, [-1e12, 3.0, 1.0, 2.0, 5.0], "b"), (5, [1.0], "b")]
    assert _got(vectors(rows), parts=4, entries=3) == _plain(rows, 4, 3, 2)
    assert _got(vectors(rows[:1]), parts=16) == _plain(rows[:1], 16, 64, 2)


def test_label_errors_and_empty(vectors):
    df, books = vc.compressed(vectors(_rows()), "label", parts=4)
    got = vc.with_label_errors(df).collect()
    sums = {}
    for r in got:
        sums[r.label] = sums.get(r.label, 0) + r.error
    assert len(got) == df.count() and all(r.label_error == sums[r.label] for r in got)
    none, books = vc.compressed(vectors([(1, None, "a")]), "label")
    assert vc.with_label_errors(none).collect() == [] and books == [] and vc.decoded(none, books).collect() == []
    back = vc.decoded(*vc.compressed(vectors(_rows()), "label", parts=4))
    assert {len(r.approximate) for r in back.collect()} == {8}


def test_bounds_skip_scans_and_keep_the_nearest():
    """Net moves: entries that went and came back cost nothing, though their summed moves are long."""
    rng = np.random.default_rng(3)
    x = np.floor(rng.standard_normal((3000, 8)) * 300)
    first = np.stack([x[:32, :4], x[:32, 4:]])
    away = first + np.floor(rng.standard_normal(first.shape) * 400)
    bounds = vc.Bounds(len(x), 2)
    seen = []
    for books in ([first], [first, away], [first, away, first + 1]):
        before = bounds.code.copy()
        _, scans = vc.assign(x, bounds, books, False)
        seen.append(scans)
        for p in range(2):
            assert (bounds.code[:, p] == np.argmin(vc.distances(x[:, p * 4:p * 4 + 4], books[-1][p]), axis=1)).all()
        assert books[-1] is not away or (before != bounds.code).any()
    still = vc.Bounds(len(x), 2)
    vc.assign(x, still, [first], False)
    _, scans = vc.assign(x, still, [first, first + 1], False)
    assert seen[0] == 6000 and scans < 600


def test_stamped_bounds_use_the_net_move():
    """A bound of round 0 that survives round 1 is loosened by the move from round 0 on, not by both."""
    x = np.zeros((1, 2))
    near, far = np.array([[[0.0, 1.0], [100.0, 0.0]]]), np.array([[[0.0, 1.0], [60.0, 0.0]]])
    bounds = vc.Bounds(1, 1)
    for books in ([near], [near, far]):
        vc.assign(x, bounds, books, False)
    assert bounds.lower_round[0, 0] == 0 and vc.assign(x, bounds, [near, far, near], False)[1] == 0
    (move, others), _, _ = vc.moves([near, far, near], 0)
    assert move[1] == 0 and others[0] == 0 and vc.moves([near, far], 0)[0][0][1] == 40


def test_integers_round_down():
    got = vc.integers(pa.array([[0.001, -0.001], [1e300, -3.5]]), 3)
    assert got.tolist() == [[0, -1, 0], [int(1e300) * 256, -896, 0]]
