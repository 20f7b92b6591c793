"""Removal of repeated passages by recompression.

Every text is rewritten in rounds: runs of equal symbols become one symbol,
then neighbours a b become one symbol where a falls on the left and b on the
right side of a split of all symbols. A symbol's name depends only on the words
it stands for, so all tasks name equal runs and pairs equally, without a
dictionary. Whether two symbols are joined depends on these two alone, so equal
passages are rewritten equally inside, whatever surrounds them; ``Rounds``
tracks for each window of ``k`` words which symbols its own words determine.

1. Each window is represented by one symbol of its determined inside, the least
   by name, together with its two neighbours, from the highest round that has
   three. Neighbouring windows mostly share it. One row leaves a task per
   stretch of windows with the same representative: its key, and the name of
   all words of the stretch.
2. A window can only repeat where its key occurs again. Stretches that are
   repeated whole are settled by their names.
3. Of the other stretches with a shared key, one text pass gives each window's
   name, and windows whose name occurs again are repeats.
4. Words covered by a repeated window go; texts that lose none were finished in
   the first pass.

Counts are combined before they are shuffled, a bitmap of fixed size keeps
unshared keys and unconcerned texts from being shuffled at all, and names have
64 bits next to an independent 64-bit key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopscope.llm.shared import bitmap, filtered, numbered, small_batches, written
from shopscope.llm.words import U, mix, text_batches, words_of

WINDOW = 35
ROUNDS = 3
KEY_BITS, ROW_BITS = 1 << 25, 1 << 23

_A, _B, _C = U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F), U(0x165667B19E3779F9)
_A_INVERSE = U(pow(int(_A), -1, 1 << 64))


class Level:
    """Symbols after a round, and which of them each window determines: [first, stop)."""

    def __init__(self, start, name, opens, first, stop):
        self.start, self.name, self.opens, self.first, self.stop = start, name, opens, first, stop

    def next(self, salt: int) -> Level:
        """One round: runs, then pairs."""
        n = len(self.name)
        fresh = np.ones(n, dtype=bool)
        fresh[1:] = (self.name[1:] != self.name[:-1]) | self.opens[1:]
        run = np.cumsum(fresh) - 1
        at = np.flatnonzero(fresh)
        size = np.diff(np.append(at, n))
        name, opens = self.name[at], self.opens[at]
        many = size > 1
        name[many] = mix(name[many] * _A + size[many].astype(U))
        right = ((name ^ U(salt)) * _C >> U(63)).astype(bool)
        joins = np.zeros(len(name), dtype=bool)  # with the symbol before
        joins[1:] = right[1:] & ~right[:-1] & ~opens[1:]
        symbol = np.cumsum(~joins) - 1
        head = np.flatnonzero(~joins)
        merged = name[head]
        two = np.flatnonzero(np.append(joins, False)[head + 1])
        merged[two] = mix(merged[two] * _A + name[head[two] + 1] * _B)
        # the outer runs may go on outside the window; then an outer symbol may be half a pair
        last = len(name) - 1
        first = np.minimum(run[self.first] + 1, last)
        stop = run[np.maximum(self.stop - 1, 0)]
        first = np.minimum(first + right[first], last)
        stop = stop - ~right[np.maximum(stop - 1, 0)]
        ok = (stop > first) & (self.stop > self.first)
        return Level(self.start[at[head]], merged, opens[head], symbol[first], np.where(ok, symbol[np.maximum(stop - 1, 0)] + 1, symbol[first]))

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Place of the least name in each range [lo, hi), the leftmost of equal ones."""
        out = np.empty(len(lo), dtype=np.int64)
        size = hi - lo
        table, width = np.arange(len(self.name)), 1
        while True:
            now = np.flatnonzero((size >= width) & (size < 2 * width))
            if len(now):
                a, b = table[lo[now]], table[hi[now] - width]
                out[now] = np.where(self.name[a] <= self.name[b], a, b)
            if not (size >= 2 * width).any():
                return out
            a, b = table[:-width], table[width:]
            table = np.where(self.name[a] <= self.name[b], a, b)
            width *= 2


def prefix_names(names: np.ndarray) -> np.ndarray:
    """Running sum of name[j] * _A ** -j: a stretch is a difference of two, times a power."""
    return np.concatenate((np.zeros(1, dtype=U), np.cumsum(names * _powers(_A_INVERSE, len(names))[:-1], dtype=U)))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n + 1, base, dtype=U)
    p[0] = 1
    return np.multiply.accumulate(p)


def stretch_names(names: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Names of the words [start, stop): equal for equal words wherever they stand."""
    prefix = prefix_names(names)
    return (prefix[stop] - prefix[start]) * _powers(_A, len(names))[start]


def stretches(names: np.ndarray, bounds: np.ndarray, k: int = WINDOW, rounds: int = ROUNDS):
    """(text, first window in the text, windows, key, name) of each stretch, and its first place."""
    size = np.diff(bounds)
    n_win = np.maximum(size - k + 1, 0)
    total = int(n_win.sum())
    if not total:
        e = np.zeros(0, dtype=np.int64)
        return e, e, e, e.astype(U), e.astype(U), e
    text = np.repeat(np.arange(len(size)), n_win)
    win = np.arange(total) - np.repeat(np.cumsum(n_win) - n_win, n_win) + np.repeat(bounds[:-1], n_win)
    opens = np.zeros(len(names), dtype=bool)
    opens[bounds[:-1][size > 0]] = True
    levels = [Level(np.arange(len(names)), names, opens, win, win + k)]
    for r in range(rounds):
        levels.append(levels[-1].next(int(mix(np.array([r + 1], dtype=U))[0])))
    anchor = np.full(total, -1, dtype=np.int64)
    place = np.zeros(total, dtype=np.int64)
    key = np.zeros(total, dtype=U)
    left = np.arange(total)
    base = 0
    for r in range(rounds, -1, -1):
        lv = levels[r]
        fits = lv.stop[left] - lv.first[left] >= 3
        now = left[fits]
        left = left[~fits]
        if len(now):
            j = lv.least(lv.first[now] + 1, lv.stop[now] - 1)
            anchor[now], place[now] = base + j, lv.start[j]
            key[now] = lv.name[j - 1] * _A + lv.name[j] * _B + lv.name[j + 1] * _C + U(r)
        base += len(lv.name)
    new = np.ones(total, dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    length = np.diff(np.append(at, total))
    start = win[at]
    content = stretch_names(names, start, start + length + k - 1)
    offset = (place[at] - start).astype(U)
    return text[at], start - bounds[:-1][text[at]], length, mix(key[at]), mix(content + mix(offset * U(1 << 32) + length.astype(U))), start


def _names(words: pa.DictionaryArray) -> np.ndarray:
    of = np.fromiter(map(xxhash.xxh3_64_intdigest, words.dictionary.to_pylist()), dtype=U, count=len(words.dictionary))
    return of[words.indices.to_numpy(zero_copy_only=False)]


def _joined(words: pa.Array, bounds: np.ndarray) -> pa.Array:
    """Each text's words joined by one space."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), words.cast(pa.string())), " ")


def _digests(words: pa.Array, bounds: np.ndarray) -> list[str]:
    """sha256 of each text's words joined by one space."""
    return [hashlib.sha256(x.as_buffer() or b"").hexdigest() for x in _joined(words, bounds)]


FIRST_PASS = "row long, doc_id long, n_words long, sha256 string, first int, windows int, key long, name long"


def first_pass(docs: DataFrame, k: int = WINDOW) -> DataFrame:
    """A row per text (doc_id, n_words, sha256 of all words) and one per stretch (first, windows, key, name)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "doc_id", "n_words", "sha256", "first", "windows", "key", "name"]
        for b in text_batches(batches):
            words, bounds = words_of(b.column("text"))
            n = len(b)
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("doc_id"), pa.array(np.diff(bounds)), pa.array(_digests(words.dictionary_decode(), bounds), pa.string()), *(pa.nulls(n, t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.int64()))], names)
            text, first, windows, key, name, _ = stretches(_names(words), bounds, k)
            n = len(text)
            rows = b.column("row").take(pa.array(text))
            yield pa.RecordBatch.from_arrays([rows, pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()), pa.array(first.astype(np.int32)), pa.array(windows.astype(np.int32)), pa.array(key.view(np.int64)), pa.array(name.view(np.int64))], names)

    return docs.mapInArrow(scan, FIRST_PASS)


def _repeated(rows: DataFrame, *name: str) -> DataFrame:
    """Names that occur more than once."""
    return rows.groupBy(*name).agg(F.count(F.lit(1)).alias("times")).filter("times > 1")


def window_names(texts: DataFrame, k: int = WINDOW) -> DataFrame:
    """(row, first, open, key, name) of each window of the asked stretches (first, windows, key, open)."""

    def names_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches):
            words, bounds = words_of(b.column("text"))
            asked = b.column("asked")
            flat = asked.flatten()
            of = np.repeat(np.arange(len(b)), pc.list_value_length(asked).to_numpy())
            first, n, key, is_open = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))
            which = np.repeat(np.arange(len(of)), n)
            at = first[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
            start = at + bounds[of[which]]
            name = mix(stretch_names(_names(words), start, start + k))
            yield pa.RecordBatch.from_arrays([b.column("row").take(pa.array(of[which])), pa.array(at.astype(np.int32)), pa.array(is_open[which]), pa.array(key[which]), pa.array(name.view(np.int64))], ["row", "first", "open", "key", "name"])

    return texts.mapInArrow(names_of, "row long, first int, open boolean, key long, name long")


def kept_words(texts: DataFrame, k: int = WINDOW) -> DataFrame:
    """(row, n_removed, kept) of texts with the windows to remove (first, windows)."""

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches):
            words, bounds = words_of(b.column("text"))
            gone = b.column("gone")
            flat = gone.flatten()
            of = np.repeat(np.arange(len(b)), pc.list_value_length(gone).to_numpy())
            first, n = (flat.field(i).to_numpy() for i in range(2))
            change = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(change, first + bounds[of], 1)
            np.add.at(change, first + bounds[of] + n + k - 1, -1)
            stays = np.cumsum(change)[:-1] == 0
            before = np.concatenate(([0], np.cumsum(stays)))[bounds]
            kept = words.filter(pa.array(stays)).dictionary_decode()
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(np.diff(bounds) - np.diff(before)), _joined(kept, before)], ["row", "n_removed", "kept"])

    return texts.mapInArrow(remove, "row long, n_removed long, kept string")


def without_repeats(docs: DataFrame, k: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(all texts: row, doc_id, n_words, sha256 of their words; changed ones: row, n_removed, kept).

    Rows are told apart by their number in ``numbered`` rows. Null texts have no words; texts shorter than the window lose none; repeated rows are repeats of each
    other. An empty table gives empty results. Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    docs = numbered(docs, "row", F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    seen = written(first_pass(docs, k), "first-pass")
    parts = seen.filter("key is not null").select("row", "first", "windows", "key", "name")
    shared = filtered(parts, "key", bitmap(_repeated(parts, "key"), "key", KEY_BITS))
    shared = written(shared, "shared-stretches")
    names = written(shared.groupBy("key", "name").agg(F.count(F.lit(1)).alias("times"), F.min("row").alias("one")), "stretch-names")
    # keys that occur again with other words around them
    mixed = names.groupBy("key").agg(F.sum("times").alias("all"), F.count_if(F.col("times") == 1).alias("opens")).filter("all > 1 and opens > 0").select("key")
    settled = shared.join(names.filter("times > 1").select("key", "name"), ["key", "name"]).select("row", "first", "windows")
    asked = names.join(mixed, "key").select("key", "name", "one", (F.col("times") == 1).alias("open"))
    asked = shared.join(asked, ["key", "name"]).filter("row = one")
    asked = written(asked.groupBy("row").agg(F.collect_list(F.struct("first", "windows", "key", "open")).alias("asked")), "asked")

    text = docs.select("row", "text")
    windows = written(window_names(filtered(text, "row", bitmap(asked, "row", ROW_BITS)).join(asked, "row"), k), "window-names")
    again = _repeated(windows, "key", "name").select("key", "name")
    found = filtered(windows.filter("open"), "name", bitmap(again, "name", KEY_BITS)).join(again, ["key", "name"])
    gone = settled.union(found.select("row", "first", F.lit(1).alias("windows")))
    gone = written(gone.groupBy("row").agg(F.collect_list(F.struct("first", "windows")).alias("gone")), "windows-to-remove")
    changed = kept_words(filtered(text, "row", bitmap(gone, "row", ROW_BITS)).join(gone, "row"), k)
    return seen.filter("key is null").select("row", "doc_id", "n_words", "sha256"), changed


def repeat_digest(docs: DataFrame, k: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row of ``docs``; see ``without_repeats``."""
    texts, changed = without_repeats(docs, k)
    new = changed.select("row", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("new"))
    both = texts.join(new, "row", "left")
    return both.select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("new", "sha256").alias("kept_sha256"))
