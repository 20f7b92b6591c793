"""Best-fit packing of documents into fixed-length sequences, large items matched first.

Lengths are integers up to the capacity, so the table of how many pieces have
each length (at most ``capacity`` rows, however large the corpus) decides the
whole packing. The steps:

1. one pass encodes the documents, cuts only those longer than the capacity,
   and numbers the pieces of each length within its task; no text is shuffled;
2. the counts per (task, length) give every piece a rank among all pieces of
   its length;
3. the plan, from the counts per length alone: pieces above a third of the
   capacity go at most two to a sequence, the largest matched with the largest
   that fits; smaller lengths, longest first, fill the tightest gap that takes
   them. Equal sequences are planned as one run, so the plan has a few runs per
   length;
4. each piece looks up the run that holds its rank.

Nulls: a null text is empty and has its end id only; a null doc_id stays null.
Repeated rows are packed as often as they occur. An empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopscope.llm.shared import written
from shopscope.llm.tokens import batches_by_bytes, encoder, tokenizer_path

CAPACITY = 2048
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, k long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """Pieces of every document, numbered (``k``) among those of their length in their task (``part``)."""
    path = path or tokenizer_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, enc = TaskContext.get().partitionId(), encoder(path)
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for b in batches:
            done = 0
            for texts in batches_by_bytes(b.column(1)):
                ids, bounds = enc.flat(texts)
                ids = np.insert(ids, bounds[1:], end_id).astype("<u4")
                sizes = np.diff(bounds) + 1
                n = -(-sizes // capacity)
                doc = np.repeat(np.arange(len(sizes)), n)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                length = np.minimum(sizes[doc] - start, capacity)
                raw, at = memoryview(ids.tobytes()), ((np.cumsum(sizes) - sizes)[doc] + start) * 4
                crc = [zlib.crc32(raw[a:c]) for a, c in zip(at.tolist(), (at + length * 4).tolist())]
                order = np.argsort(length, kind="stable")
                by = length[order]
                k = np.empty(len(length), dtype=np.int64)
                k[order] = np.arange(len(by)) - np.searchsorted(by, by) + seen[by]
                seen += np.bincount(length, minlength=capacity + 1)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(done, len(texts)).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, type=pa.int64()), pa.array(np.full(len(doc), part)), pa.array(k)],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "part", "k"])
                done += len(texts)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECES)


class Plan:
    """Runs of equal sequences from the counts per length."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.capacity, self.left = capacity, {n: c for n, c in counts.items() if c > 0}
        self.rank = dict.fromkeys(self.left, 0)
        self.sequences = 0
        self.gaps: dict[int, list[tuple[int, int]]] = {}
        self.open: list[int] = []  # gaps that have sequences, ascending
        self.runs: list[tuple[int, int, int, int, int]] = []
        self._match_large()
        self._fill_small()
        self.runs.sort()

    def _put(self, length: int, sequences: int, first: int, offset: int, each: int = 1) -> None:
        """Next pieces of a length: ``each`` into every one of ``sequences`` from ``first`` on."""
        self.runs.append((length, self.rank[length], first, each, offset))
        self.rank[length] += sequences * each
        self.left[length] -= sequences * each

    def _leave(self, gap: int, first: int, sequences: int) -> None:
        if gap and sequences:
            if not self.gaps.setdefault(gap, []):
                insort(self.open, gap)
            self.gaps[gap].append((first, sequences))

    def _match_large(self) -> None:
        large = sorted(n for n in self.left if 3 * n > self.capacity)
        while large:
            a = large[-1]
            if self.left[a] == 0:
                large.pop()
                continue
            i = bisect_right(large, self.capacity - a) - 1
            while i >= 0 and (self.left[large[i]] == 0 or large[i] == a and self.left[a] < 2):
                if self.left[large[i]] == 0:
                    large.pop(i)
                i -= 1
            if i < 0:
                m, used = self.left[a], a
                self._put(a, m, self.sequences, 0)
            else:
                b = large[i]
                m, used = (self.left[a] // 2 if a == b else min(self.left[a], self.left[b])), a + b
                self._put(a, m, self.sequences, 0)
                self._put(b, m, self.sequences, a)
            self._leave(self.capacity - used, self.sequences, m)
            self.sequences += m

    def _fill_small(self) -> None:
        for n in sorted((n for n in self.left if 3 * n <= self.capacity), reverse=True):
            while self.left[n]:
                i = bisect_left(self.open, n)
                if i == len(self.open):  # no gap takes it: new sequences
                    gap = self.capacity
                    first, there = self.sequences, -(-self.left[n] // (gap // n))
                    self.sequences += there
                else:
                    gap = self.open[i]
                    first, there = self.gaps[gap].pop()
                    if not self.gaps[gap]:
                        self.open.pop(i)
                each, offset = gap // n, self.capacity - gap
                full = min(there, self.left[n] // each)
                if full:
                    self._put(n, full, first, offset, each)
                    self._leave(gap - each * n, first, full)
                if full < there and self.left[n]:
                    rest = self.left[n]
                    self._put(n, 1, first + full, offset, rest)
                    self._leave(gap - rest * n, first + full, 1)
                    full += 1
                self._leave(gap, first + full, there - full)

    def arrays(self) -> tuple[np.ndarray, ...]:
        """(length, first rank, first sequence, pieces in each, offset) of each run, ascending."""
        return tuple(np.array(x, dtype=np.int64) for x in zip(*self.runs)) if self.runs else (np.zeros(0, dtype=np.int64),) * 5


def best_fit_packing(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = 0) -> DataFrame:
    """One row per piece with its sequence and its place there."""
    cut = written(pieces(docs, path, capacity, end_id), "pieces")
    counts = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    # at most ``capacity`` rows, whatever the input
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    lengths, ranks, firsts, each, offsets = Plan(totals, capacity).arrays()
    keys = lengths << 44 | ranks

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            run = np.searchsorted(keys, length << 44 | rank, side="right") - 1
            nth = rank - ranks[run]
            cols = {"sequence_id": firsts[run] + nth // each[run], "offset": offsets[run] + nth % each[run] * length}
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*(b.column(x) for x in names), *map(pa.array, cols.values())], [*names, *cols])

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("base"))
    ranked = cut.join(base, ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("k")).alias("rank"))
    return ranked.mapInArrow(place, PACKED)
