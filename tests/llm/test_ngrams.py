"""N-gram join, components and repeated passages against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from shopscope.llm import ngram_join as nj
from shopscope.llm import recompression as rc
from shopscope.llm.components import components

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def _shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def _components(rows):
    sets, label = [_shingles(t) for _, t in rows], list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]) and label[i] != label[j]:
                x, y = label[i], label[j]
                label = [min(x, y) if c in (x, y) else c for c in label]
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        out.append((doc, len(sets[i]), min(ids) if ids else None))
    return sorted(out, key=str)


def _family(rng, n, words, changes):
    base = [f"w{rng.randrange(3000)}" for _ in range(words)]
    for _ in range(n):
        t = list(base)
        for _ in range(rng.randrange(changes)):
            t[rng.randrange(words)] = f"x{rng.randrange(3000)}"
        yield " ".join(t)


def _texts(seed):
    rng = random.Random(seed)
    texts = [*_family(rng, 40, 120, 9), *_family(rng, 30, 60, 8), *_family(rng, 25, 12, 3), *_family(rng, 20, 6, 2)]
    texts += [" ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(1, 90))) for _ in range(60)]
    shared = " ".join(f"s{i}" for i in range(30))
    texts += [f"{shared} {' '.join(f'u{rng.randrange(9999)}' for _ in range(rng.randrange(1, 40)))}" for _ in range(40)]
    texts += [texts[0]] * 30 + ["A b C d E f", "a B c D e F\n", "one", "ONE", "two words", "", None, " \t\n", "de " * 200, "de " * 300]
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_components_equal_all_pairs(docs, seed):
    rows = [*enumerate(_texts(seed)), (None, "one"), (3, "two words"), (None, "null id alone here")]
    got = sorted((tuple(r) for r in nj.ngram_components(docs(rows)).collect()), key=str)
    assert got == _components(rows)


def test_ngram_components_with_few_frequent_names(docs, monkeypatch):
    monkeypatch.setattr(nj, "FREQUENT", 5)
    monkeypatch.setattr(nj, "LIST_BITS", 64)
    monkeypatch.setattr(nj, "SET_BITS", 64)
    monkeypatch.setattr(nj, "CELL", 6)
    rows = list(enumerate(_texts(3)))
    assert sorted((tuple(r) for r in nj.ngram_components(docs(rows)).collect()), key=str) == _components(rows)


def test_ngram_components_empty(docs):
    assert nj.ngram_components(docs([])).count() == 0
    assert sorted(map(tuple, nj.ngram_components(docs([(1, None), (2, "")])).collect())) == [(1, 0, 1), (2, 0, 2)]


def test_divide_skip_equals_counting():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(200)]
    found = nj.DivideSkip(sets)
    for q in sets[:80]:
        want = [i for i, s in enumerate(sets) if 100 * len(np.intersect1d(q, s)) >= 75 * len(np.union1d(q, s))]
        assert found.search(q).tolist() == want


def test_one_of_each_keeps_one_row_per_group(docs, tmp_path, spark):
    rows = [(5, "a b c d e f g h"), (3, "a b c d e f g h"), (3, "a b c d e f g h"), (9, "other words that stand alone here"), (10, ""), (11, None)]
    path = str(tmp_path / "docs")
    docs(rows).write.parquet(path)
    got = nj.one_of_each(spark.read.parquet(path))
    assert got.columns == docs(rows).columns
    assert sorted(r.doc_id for r in got.collect()) == [3, 9, 10, 11]


def test_components_of_chains_stars_and_loops(spark, docs):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, None), (300, 301), (301, 300), (300, 301)]
    docs([])
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    want = {i: 0 for i in range(51)} | {i: 100 for i in range(100, 140)} | {300: 300, 301: 300}
    assert got == want


def _kept(rows, k):
    words = [WORD.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[i:i + k]) for w in words for i in range(len(w) - k + 1))
    out = []
    for (doc, _), w in zip(rows, words):
        gone = {j for i in range(len(w) - k + 1) if seen[tuple(w[i:i + k])] > 1 for j in range(i, i + k)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def _passages(seed, k):
    rng = random.Random(seed)
    word = lambda m: f"w{rng.randrange(m)}"
    passages = [[word(60) for _ in range(n)] for n in (k - 1, k, k + 1, 3 * k)] + [["de"] * (2 * k), ["a", "b"] * k]
    texts = []
    for _ in range(120):
        t = [word(rng.choice([3, 60, 2000])) for _ in range(rng.randrange(0, 80))]
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            a, b = sorted((rng.randrange(len(p) + 1), rng.randrange(len(p) + 1))) if rng.random() < 0.4 else (0, len(p))
            at = rng.randrange(len(t) + 1)
            t[at:at] = p[a:b]
        texts.append(" ".join(t))
    return texts + [texts[0]] * 3 + ["", None, " ", "De " * 500, "x y " * 90, "é ü\tö\n" * 40]


@pytest.mark.parametrize("seed,k", [(1, 35), (2, 35), (3, 12), (4, 12), (5, 5)])
def test_repeats_equal_counting_windows(docs, tmp_path, spark, seed, k):
    rows = [*enumerate(_passages(seed, k)), (None, "null id " * 20), (3, "again and")]
    path = str(tmp_path / "docs")
    docs(rows).write.parquet(path)
    got = sorted((tuple(r) for r in rc.repeat_digest(spark.read.parquet(path), k).collect()), key=str)
    assert got == _kept(rows, k)


def test_repeats_with_full_bitmaps_and_empty_tables(docs, monkeypatch):
    assert rc.repeat_digest(docs([])).count() == 0
    monkeypatch.setattr(rc, "KEY_BITS", 64)
    monkeypatch.setattr(rc, "ROW_BITS", 64)
    rows = list(enumerate(_passages(6, 12)))
    assert sorted((tuple(r) for r in rc.repeat_digest(docs(rows, 1), 12).collect()), key=str) == _kept(rows, 12)


def test_windows_determine_their_representative():
    """A passage's stretches are the same in any surroundings, but for those at its ends."""
    rng = np.random.default_rng(1)
    passage = rng.integers(0, 50, 200).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    keys = []
    for seed in range(4):
        around = np.random.default_rng(seed).integers(0, 2**62, 60).astype(np.uint64)
        names = np.concatenate([around[:30], passage, around[30:]])
        _, first, n, key, name, _ = rc.stretches(names, np.array([0, len(names)]), 35)
        inside = (first >= 30) & (first + n + 34 <= 230)
        keys.append(dict(zip((key[inside] ^ name[inside]).tolist(), n[inside].tolist())))
    common = set(keys[0]).intersection(*keys[1:])
    assert sum(keys[0][x] for x in common) >= 0.8 * (200 - 34)
