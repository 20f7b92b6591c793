"""Token counts: batch encoding in Arrow functions that return lengths only.

Texts stay where they were read: no shuffle. A task's Arrow batches are dealt
anew into runs of about equal bytes; texts above ``LONG_BYTES`` are split at
boundaries no token crosses, so a run's memory doesn't follow its longest text.
For tokenizer files that ``BatchEncoder`` can cut, the boundary is ASCII white
space; for others it is a letter, one space, a letter, used only if probes show
that the tokenizer starts a new word there. Otherwise the text stays whole.

Nulls count as empty (0 bytes, 0 tokens); repeated rows give repeated results;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from shopscope.llm.tokens import batches_by_bytes, encoder, tokenizer_path

LONG_BYTES = 1_000_000
_BOUNDARY = re.compile("[A-Za-z](?= [A-Za-z])")
_SPACE = re.compile("(?<=[^\t-\r ])(?=[\t-\r ])")
_PROBES = ("ab cd", "The end of it", "x y", "don't stop Now")
SCHEMA = "doc_id long, n_bytes long, n_tokens long"


def safe_parts(text: str, boundary: re.Pattern, keep_space: bool, size: int = LONG_BYTES) -> list[str]:
    """The text in parts of about ``size`` characters, cut only at a boundary."""
    parts, a = [], 0
    while len(text) - a > size:
        m = boundary.search(text, a + size)
        if not m:
            break
        parts.append(text[a:m.end()])
        a = m.end() + (not keep_space)
    return [*parts, text[a:]]


class Counter:
    """Lengths of texts under one tokenizer file (.json or .model)."""

    def __init__(self, path: str):
        self.boundary, self.keep_space = _BOUNDARY, True
        if path.endswith(".model"):
            import sentencepiece

            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            self.lengths = lambda arr: np.array([len(x) for x in sp.encode([t or "" for t in arr.to_pylist()], num_threads=1)], dtype=np.int64)
            self.keep_space = False
            safe = all(len(sp.encode(p)) == sum(len(sp.encode(w)) for w in p.split(" ")) for p in _PROBES)
        else:
            enc = encoder(path)
            self.lengths = enc.lengths
            count = lambda t: int(enc.lengths(pa.array([t]))[0])
            safe = all(count(p) == sum(count(w) for w in re.split("(?= )", p)) for p in _PROBES)
            if enc.cut:
                self.boundary = _SPACE
        self.safe = safe

    def count(self, texts: pa.Array) -> Iterator[int]:
        for run in batches_by_bytes(texts):
            n_bytes = pc.fill_null(pc.binary_length(run), 0).to_numpy(zero_copy_only=False)
            long = np.flatnonzero(n_bytes > LONG_BYTES) if self.safe else np.array([], dtype=int)
            if not len(long):
                yield from self.lengths(run).tolist()
                continue
            for t in run:  # a run with a long text is short
                parts = safe_parts(t.as_py() or "", self.boundary, self.keep_space)
                yield sum(int(self.lengths(pa.array([p]))[0]) for p in parts)


_COUNTERS: dict[str, Counter] = {}


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row of ``docs``; ``path``: a .json or .model file."""
    path = path or tokenizer_path()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _COUNTERS:
            _COUNTERS[path] = Counter(path)
        for b in batches:
            text = b.column(1)
            n_bytes = pc.fill_null(pc.binary_length(text), 0).cast(pa.int64())
            n = pa.array(_COUNTERS[path].count(text), type=pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), n_bytes, n], ["doc_id", "n_bytes", "n_tokens"])

    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(counted, SCHEMA)
