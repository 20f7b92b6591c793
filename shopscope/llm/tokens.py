"""Batch encoding with the ``tokenizers`` library inside Arrow functions.

When a tokenizer cuts words apart before merging and drops white space, the
ids of a text are the ids of its white-space separated chunks in order.
``BatchEncoder`` uses that: Arrow splits a batch's texts into chunks, each
distinct one is encoded once by the library, a bounded cache keeps them
between batches, and numpy lays the ids out again. The cuts:

* a tokenizer file with the word pattern and normalizers below: texts are cut
  at ASCII white space (special strings hold none, so they stay whole); a
  chunk of letters or digits and then ASCII punctuation is cut between the
  two, where the pattern always ends a word;
* any other tokenizer: every text is one chunk and nothing is kept.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

DEFAULT_TOKENIZER = "word_bpe_49k.json"
#: Entries of the cache per Python worker (about 150 bytes each); a fuller one restarts.
CACHE_ENTRIES = 1_000_000
#: Text bytes per batch: bounds the memory of a step (a longer text is a batch by itself).
BATCH_BYTES = 12_000_000
#: Distinct words that one library call encodes.
WORDS_PER_CALL = 20_000

# The word pattern and the normalizers that make the cuts safe.
WORD_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
NORMALIZERS = ["NFC", "Replace", "Lowercase"]
# ASCII punctuation without the apostrophe, which starts words of the pattern.
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_PLAIN_WORD = re.compile("[a-zß-öø-ÿ]+|[0-9]|[" + re.escape(PUNCTUATION) + "]+")


def tokenizer_path(name: str = DEFAULT_TOKENIZER) -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def batches_by_bytes(texts: pa.Array, limit: int = BATCH_BYTES) -> Iterator[pa.Array]:
    """Consecutive slices of at most ``limit`` bytes (at least one text each)."""
    if len(texts) == 0:
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < len(texts):
        before = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield texts.slice(a, b - a)
        a = b


class BatchEncoder:
    """ids of whole texts, as the library gives them without added special tokens."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = self.tok.get_vocab()
        self.dtype = np.dtype("<u2" if max(vocab.values()) < 1 << 16 else "<u4")
        steps = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        pre = [p.get("pattern", {}).get("Regex") for p in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        self.cut = steps == NORMALIZERS and pre[:1] == [WORD_PATTERN]
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        suffix = (spec.get("model") or {}).get("end_of_word_suffix")
        self.ends = None
        if self.cut and suffix:
            self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
            for token, i in vocab.items():
                self.ends[i] = token.endswith(suffix)
        self.known: dict[str, bytes] = {}

    # ------------------------------------------------------------ batches
    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, offsets: text i has ids[offsets[i]:offsets[i + 1]])."""
        found, parts, which, bounds = self._laid_out(texts)
        ids = np.frombuffer(b"".join(found), dtype=self.dtype)
        sizes = self._sizes(found)
        if parts is not None:
            ids, _ = _gather(ids, sizes, parts.ravel())
            sizes = sizes[parts].sum(axis=1)
        ids, ends = _gather(ids, sizes, which)
        return ids, np.concatenate(([0], ends))[bounds]

    def lengths(self, texts: pa.Array) -> np.ndarray:
        """Number of ids of each text; the ids are not laid out."""
        found, parts, which, bounds = self._laid_out(texts)
        sizes = self._sizes(found)
        if parts is not None:
            sizes = sizes[parts].sum(axis=1)
        return np.diff(np.concatenate(([0], np.cumsum(sizes[which])))[bounds])

    def _sizes(self, found: list[bytes]) -> np.ndarray:
        return np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // self.dtype.itemsize

    def _laid_out(self, texts: pa.Array):
        """(ids of the distinct words, the two words of each distinct chunk or None,
        chunk of each place, first place of each text)."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.cut:
            coded = texts.dictionary_encode()
            which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            return self._library(coded.dictionary.to_pylist()), None, which, np.arange(len(texts) + 1)
        split = pc.ascii_split_whitespace(texts)
        bounds = split.offsets.to_numpy().astype(np.int64)
        coded = split.flatten().dictionary_encode()
        chunks = coded.dictionary
        plain = pc.string_is_ascii(chunks)
        whole = pa.array(np.zeros(len(chunks), dtype=bool))
        for s in self.special:
            whole = pc.or_(whole, pc.match_substring(chunks, s))
        chunks = pc.if_else(pc.and_not(plain, whole), pc.ascii_lower(chunks), chunks)
        head = pc.ascii_rtrim(chunks, PUNCTUATION)
        apart = pc.and_not(pc.match_substring_regex(head, "[a-zA-Z0-9]$"), whole)
        head = pc.if_else(apart, head, chunks)
        tail = pc.if_else(apart, pc.replace_substring_regex(chunks, "(?s)^.*[a-zA-Z0-9]", ""), "")
        words = pa.concat_arrays([head, tail]).dictionary_encode()
        parts = words.indices.to_numpy(zero_copy_only=False).astype(np.int64).reshape(2, -1).T
        which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        return self._ids(words.dictionary.to_pylist()), parts, which, bounds - bounds[0]

    # ------------------------------------------------------------ distinct words
    def _ids(self, words: list[str]) -> list[bytes]:
        known = self.known
        found = list(map(known.get, words))
        new = [w for w, ids in zip(words, found) if ids is None]
        if not new:
            return found
        if len(known) + len(new) > CACHE_ENTRIES:
            known = self.known = {w: ids for w, ids in zip(words, found) if ids is not None}
        alone = new
        if self.ends is not None:
            # single words of the pattern: one call for many, its ids cut after each end of word
            plain = [w for w in new if _PLAIN_WORD.fullmatch(w)]
            alone = [w for w in new if not _PLAIN_WORD.fullmatch(w)] if len(plain) < len(new) else []
            for i in range(0, len(plain), WORDS_PER_CALL):
                some = plain[i:i + WORDS_PER_CALL]
                ids = np.array(self.tok.encode(" ".join(some), add_special_tokens=False).ids, dtype=self.dtype)
                stops = np.flatnonzero(self.ends[ids]) + 1
                if len(stops) != len(some):  # not as the file promises
                    alone += some
                    continue
                raw, a = ids.tobytes(), 0
                for w, b in zip(some, (stops * self.dtype.itemsize).tolist()):
                    known[w] = raw[a:b]
                    a = b
        known.update(zip(alone, self._library(alone)))
        return [known[w] if ids is None else ids for w, ids in zip(words, found)]

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype=self.dtype).tobytes()
                for i in range(0, len(texts), 1000)
                for e in self.tok.encode_batch_fast(texts[i:i + 1000], add_special_tokens=False)]


def _gather(ids: np.ndarray, sizes: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs ``which`` of ids that lie one after another with ``sizes``; and where each ends."""
    n = sizes[which]
    ends = np.cumsum(n)
    first = np.cumsum(sizes) - sizes
    at = np.repeat(first[which] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)
    return ids[at], ends


_ENCODERS: dict[str, BatchEncoder] = {}


def encoder(path: str) -> BatchEncoder:
    """One encoder per Python worker and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = BatchEncoder(path)
    return _ENCODERS[path]
