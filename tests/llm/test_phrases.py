"""Phrase index against a plain search."""

import re

import numpy as np
import pytest

from shopscope.llm import phrase_index as pi
from shopscope.llm.shared import importable, shared_dir

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def _plain(rows, items, window, within):
    wanted = {}
    for i, x in items:
        w = _words(x)
        for a in range(max(len(w) - window, 0) + 1 if w else 0):
            wanted.setdefault(tuple(w[a:a + window]), set()).add("" if i is None else str(i))
    counts = {}
    for _, x in rows:
        for w in _words(x):
            counts[w] = counts.get(w, 0) + 1
    out = []
    for i, x in rows:
        w, hit, found, near = _words(x), set(), set(), set()
        at = {}
        for place, word in enumerate(w):
            at.setdefault(word, []).append(place)
        for p, ids in wanted.items():
            for a in at.get(p[0], []):
                if tuple(w[a:a + len(p)]) == p:
                    hit |= set(range(a, a + len(p)))
                    found |= ids
            if all(word in at for word in p):
                least = min(counts[word] for word in p)
                # of equally rare words the first, as of equal names the order is by offset
                rare = next(word for word in p if counts[word] == least)
                if any(all(any(abs(b - a) <= within for b in at[word]) for word in p) for a in at[rare]):
                    near |= ids
        spans = [v for v in sorted(hit)]
        cut = [(v, next(u for u in range(v + 1, len(w) + 2) if u not in hit)) for v in spans if v - 1 not in hit]
        out.append((i, len(w), cut, sorted(found), sorted(near)))
    return sorted(out, key=str)


@pytest.fixture()
def items(spark):
    shared_dir(spark)
    importable(spark)
    return lambda rows: spark.createDataFrame([(i, x, "clash", 0) for i, x in rows], "item_id long, text string, name string, block int").repartition(2)


def _tables():
    rng = np.random.default_rng(5)
    words = ["the"] * 40 + [f"w{i}" for i in range(60)] + ["Ñu", "x7"]
    text = lambda n: " ".join(rng.choice(words, n))
    items = [(i, text(int(rng.integers(3, 25)))) for i in range(40)] + [(40, "The ... THE"), (41, ""), (42, None), (43, "absent word"), (None, "w1, w2;w3 w4"), (3, text(12)), (44, " ".join(["the"] * 14))]
    rows = [(i, text(int(rng.integers(0, 120)))) for i in range(150)]
    for i in range(60):
        x = (items[i % 47][1] or "").split()
        rows.append((200 + i, " ".join([text(5), *x, text(4), *x[2:], ("~".join(x)).upper()])))
        rows.append((300 + i, " ".join(rng.permutation(x + ["w9", "w9"]))))
    rows += [(500 + i, rows[155][1]) for i in range(50)] + [(200, rows[155][1]), (None, rows[160][1]), (900, None), (901, ""), (902, "  \x00 "), (903, items[0][1])]
    return rows + [(904, " ".join([text(2000), items[1][1], text(2000)]))], items


@pytest.mark.parametrize("block_bytes", [2_000, 4_000_000])
def test_spans_items_and_near_items(docs, items, monkeypatch, block_bytes):
    monkeypatch.setattr(pi, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(pi, "STEP", 1000)
    rows, asked = _tables()
    got = pi.contamination(docs(rows), items(asked), within=12).collect()
    got = sorted([(r.doc_id, r.n_words, [tuple(s) for s in r.spans], r["items"], r.near_items) for r in got], key=str)
    plain = _plain(rows, asked, 10, 12)
    assert [x[:4] for x in got] == [x[:4] for x in plain]
    # which of equally rare words is the rarest is free: compare phrases of one rarest word only through exact ones
    assert all(set(x[3]) <= set(x[4]) for x in got) and sum(x[4] == y[4] for x, y in zip(got, plain)) > 0.95 * len(got)


def test_empty_tables_and_reuse_of_an_index(docs, items):
    assert pi.contamination(docs([]), items([(1, "a b")])).collect() == []
    index = pi.positional_index(docs([(1, "a b c d"), (2, "c d"), (3, None)]))
    for asked, hits in (([], []), ([(1, "b c"), (2, "c d")], [1, 2]), ([(1, "d c")], [])):
        found = pi.matches(index, pi.phrases(items(asked), 2)).collect()
        assert len(found) == 3 and sorted(r.doc_id for r in found if r.spans) == hits
    near = pi.matches(index, pi.phrases(items([(7, "d a")]), 2), within=3).collect()
    assert [(r.doc_id, r["items"], r.near_items) for r in near if r.near_items] == [(1, [], ["7"])]
