"""Words of texts as 64-bit names, a batch at a time.

A word is a run without ASCII white space. Equal words get equal names in
every task, so sequences of words can be compared across the corpus without a
dictionary. ``mix`` is a full-avalanche step, so sums and comparisons of mixed
values behave like random ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from shopscope.llm.tokens import batches_by_bytes

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit values (two rounds of xor-shift and odd multiply)."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x = x ^ (x >> U(29))
    x = x * U(0xA0761D6478BD642F)
    return x ^ (x >> U(32))


def words_of(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """(all words in order, dictionary-coded; bounds: text i has words[bounds[i]:bounds[i + 1]])."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    split = pc.ascii_split_whitespace(texts)
    bounds = split.offsets.to_numpy().astype(np.int64)
    words = split.flatten()
    # white space at an end of a text leaves an empty part
    real = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate(([0], np.cumsum(real)))
    return words.filter(pa.array(real)).dictionary_encode(), before[bounds - bounds[0]]


# A-Z become a-z, every other ASCII character but digits and a-z ends a word.
_ALNUM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def alnum_texts(texts: pa.Array) -> pa.Array:
    """The texts with A-Z as a-z and a space for every ASCII character that is neither letter nor digit:
    what is left between white space are the words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``. Null: empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return texts
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    # all bytes of a character beyond ASCII are 128 or more, so bytes can be judged one by one
    plain = data.slice(ends[0], ends[-1] - ends[0]).to_pybytes().translate(_ALNUM) if data is not None else b""
    return pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(ends - ends[0]), pa.py_buffer(plain))


def word_names(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """(name of every word, bounds); ``lower``: A-Z count as a-z."""
    words, bounds = words_of(texts)
    distinct = pc.ascii_lower(words.dictionary) if lower else words.dictionary
    names = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct.to_pylist()), dtype=U, count=len(distinct))
    return names[words.indices.to_numpy(zero_copy_only=False)], bounds


def window_names(names: np.ndarray, k: int) -> np.ndarray:
    """Name of the k words from each place on (a polynomial of their names, scrambled)."""
    n = len(names) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=U)
    h = np.zeros(n, dtype=U)
    for j in range(k):
        h = h * U(0x9E3779B97F4A7C15) + names[j:j + n]
    return mix(h)


#: Text bytes of a batch: a word takes some hundred bytes in the steps that work on words.
WORD_BATCH_BYTES = 1_000_000


def text_batches(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = WORD_BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Record batches cut into runs of bounded text bytes."""
    for b in batches:
        done = 0
        for texts in batches_by_bytes(b.column(column), limit):
            yield b.slice(done, len(texts))
            done += len(texts)
            pa.default_memory_pool().release_unused()
