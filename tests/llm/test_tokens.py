"""Encoder, token counts, token files and packing against whole-text encoding."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from shopscope.llm import token_files as tf
from shopscope.llm.packing import Plan, best_fit_packing
from shopscope.llm.token_count import Counter, safe_parts, token_counts
from shopscope.llm.tokens import BatchEncoder, batches_by_bytes, tokenizer_path

ODD = [
    "", None, "  ", " lead", "trail ", "\n\na\tb\x0bc\x0cd\re", "it's I'LL 'stuff' don't.,x ½²3 ª º", "café. CAFÉ, é. É",
    "<|endoftext|> A<|startoftext|>B <|ENDOFTEXT|> ab..<|endoftext|>..", "isn't. a.'s A.B.C. x̸> a≯ .", "İSTANBUL ΣΑΣ x\u0085z \x1c a\x1fb\x1d c",
    "日本語 テキスト 😀.", "a\x00b", "x" * 3000, "1234567890 12.5, (3)", "!!!'s'd'''t", "word " * 5000, "word " * 5000,
]


@pytest.fixture(scope="module")
def plain():
    tok = Tokenizer.from_file(tokenizer_path())
    return lambda t: tok.encode(t or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_whole_texts(name):
    enc = BatchEncoder(tokenizer_path(name))
    ids, at = enc.flat(pa.array(ODD, type=pa.string()))
    for i, t in enumerate(ODD):
        assert ids[at[i]:at[i + 1]].tolist() == enc.tok.encode(t or "", add_special_tokens=False).ids, repr(t)
    assert enc.lengths(pa.array(ODD, type=pa.string())).tolist() == np.diff(at).tolist()


def test_batches_by_bytes_keep_all_rows():
    arr = pa.array(["a" * n for n in (5, 50, 5, 5, 0, 200, 1)] + [None])
    got = list(batches_by_bytes(arr, 20))
    assert pa.concat_arrays(got).equals(arr) and len(got) == 5
    assert list(batches_by_bytes(arr.slice(0, 0))) == []


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_long_texts_split_at_safe_boundaries(name, monkeypatch):
    import shopscope.llm.token_count as tc

    text = "The quick brown fox, it's 12 years old; and naïve. " * 40
    c = Counter(tokenizer_path(name))
    whole = int(c.lengths(pa.array([text]))[0])
    monkeypatch.setattr(tc, "LONG_BYTES", 100)
    assert c.safe and list(c.count(pa.array([text, None, "a"])))[0] == whole
    parts = safe_parts(text, c.boundary, c.keep_space, 100)
    assert len(parts) > 5 and sum(int(c.lengths(pa.array([p]))[0]) for p in parts) == whole


def test_token_counts(docs, plain):
    rows = [*enumerate(ODD), (None, "null id"), (3, " lead")]
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in token_counts(docs(rows)).collect())
    assert got == sorted((i is None, i or 0, len((t or "").encode()), len(plain(t))) for i, t in rows)
    assert token_counts(docs([])).count() == 0


def test_token_files_round_trip(spark, docs, plain):
    rows = [*enumerate(ODD), (None, "null id"), (3, " lead")]
    manifest = tf.write_token_files(docs(rows), tf.new_folder(spark, "t"), length=64)
    got = sorted(tf.read_token_files(manifest).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i))
    at, text = 0, dict(rows)
    for r in got:
        ids = np.array([*plain(text[r.doc_id]), 1], dtype="<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
    for m in manifest.collect():
        f = tf.TokenFile(m.ids_uri)
        n = -(-m.n_tokens // 64)
        assert all(len(f.sequence(i)) == 64 for i in range(n))
        real = np.concatenate([f.sequence(i)[f.mask(i)] for i in range(n)])
        assert real.tolist() == f.tokens(0, m.n_tokens).tolist() and len(real) == m.n_tokens
    assert tf.token_files(spark, docs([])).count() == 0


def _filled(plan, capacity):
    used, n = {}, {}
    for length, rank, first, each, offset in plan.runs:
        n[length] = n.get(length, 0)
        assert rank == n[length]
        of_run = [r for r in plan.runs if r[0] == length and r[1] > rank]
        stop = min((r[1] for r in of_run), default=None)
        for i in range((stop or plan.rank[length]) - rank):
            used.setdefault(first + i // each, []).append((offset + i % each * length, length))
        n[length] = stop or plan.rank[length]
    for seq in used.values():
        at = 0
        for o, length in sorted(seq):
            assert o == at
            at += length
        assert at <= capacity and sum(3 * x > capacity for _, x in seq) <= 2
    return used, n


@pytest.mark.parametrize("seed", range(6))
def test_plan_places_every_piece_once_and_close_to_the_bound(seed):
    rng = np.random.default_rng(seed)
    cap = 100
    lengths = rng.integers(1, cap + 1, 3000) if seed % 2 else np.minimum(cap, rng.geometric(0.04, 3000))
    counts = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
    used, n = _filled(Plan(counts, cap), cap)
    assert n == counts
    bound = max(-(-lengths.sum() // cap), (2 * lengths > cap).sum())
    assert len(used) <= 1.02 * bound + 1


def test_plan_large_matching_is_optimal():
    # 60+40, 55+45, 50+50, and 51 alone with 49
    used, _ = _filled(Plan({60: 1, 40: 1, 55: 1, 45: 1, 50: 2, 51: 1, 49: 1}, 100), 100)
    assert len(used) == 4
    assert Plan({}, 100).sequences == 0


def test_packing(docs, plain):
    rows = [*enumerate(ODD), (None, "null id"), (3, " lead"), (100, "long words " * 4000)]
    got = best_fit_packing(docs(rows), capacity=128).collect()
    text = dict(rows)
    seqs = {}
    for r in got:
        ids = [*plain(text[r.doc_id]), 0]
        part = ids[r.start:r.start + r.length]
        assert r.start == r.piece * 128 and len(part) == r.length
        assert r.ids_crc32 == zlib.crc32(np.array(part, dtype="<u4").tobytes())
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 128
    total = sum(len(plain(t)) + 1 for _, t in rows)
    assert sum(r.length for r in got) == total and len(seqs) <= 1.05 * total / 128 + 2
    assert best_fit_packing(docs([])).count() == 0
