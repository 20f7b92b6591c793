"""Importance resampling against a plain recomputation."""

import hashlib
import math
import re
import zlib

import pytest

from shopscope.llm import importance as im
from shopscope.llm.shared import importable, shared_dir

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _features(text):
    w = WORDS.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return w, [zlib.crc32(" ".join(w[i:i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def _plain(rows, target, percent):
    s, t = [0] * 10000, [0] * 10000
    for counts, texts in ((s, [x for _, x in rows]), (t, target)):
        for x in texts:
            for b in _features(x)[1]:
                counts[b] += 1
    S, T = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(10000)]
    out = []
    for i, x in rows:
        w, f = _features(x)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(w)])
    may = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for rank, r in enumerate(may[:len(may) * percent // 100], 1):
        r[4] = rank
    return sorted([tuple(r[:5]) for r in out], key=str)


def _rows():
    rows = [(i, " ".join(f"w{(i * 7 + j * j) % 97}" for j in range(10 + i % 30))) for i in range(400)]
    rows += [(1000 + i, rows[37][1]) for i in range(200)]  # copies
    rows += [(37, rows[37][1]), (None, rows[38][1]), (2000, None), (2001, ""), (2002, " ,. \x00"), (2003, "Éa-B c3_D")]
    return rows + [(2004, " ".join(f"x{i % 3001}" for i in range(200_000))), (2005, "a" * 100_000)]


@pytest.fixture()
def target(spark):
    return lambda texts: spark.createDataFrame([(i, x, "clash") for i, x in enumerate(texts)], "item_id long, text string, doc_id string")


@pytest.mark.parametrize("percent", [5, 37, 100, 0])
def test_weights_scores_and_ranks(docs, target, percent):
    rows = _rows()
    texts = ["w1 w8 w15 W22-w29", None, "", rows[5][1]]
    got = im.resampled(docs(rows), target(texts), percent=percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == _plain(rows, texts, percent)


def test_empty_tables(docs, target):
    assert im.resampled(docs([]), target(["a b"])).collect() == []
    rows = _rows()[:50]
    assert sorted([tuple(r) for r in im.resampled(docs(rows), target([]), percent=50).collect()], key=str) == _plain(rows, [], 50)


def test_bracket_is_widened_until_it_holds_the_rank(spark):
    shared_dir(spark)
    importable(spark)
    rows = spark.createDataFrame([(i // 300,) for i in range(3000)], "score long").repartition(4)  # heavy ties
    for k in (1, 299, 300, 301, 1500, 3000):
        low, high, above = im.bracket(rows, 3000, k, margin=1e-6, accuracy=3)
        assert above == sum(i // 300 > high for i in range(3000)) < k <= sum(i // 300 >= low for i in range(3000))


def test_crc_of_joined_strings():
    import numpy as np

    parts = [b"", b"a", b"\xc3\xb1o", b"x" * 5000, bytes(range(256))]
    crc = np.array([zlib.crc32(p) for p in parts], dtype=np.uint32)
    for first in parts:
        got = im.joined_crc(np.full(len(parts), zlib.crc32(first), dtype=np.uint32), crc, np.array([len(p) for p in parts]))
        assert got.tolist() == [zlib.crc32(first + p) for p in parts]
