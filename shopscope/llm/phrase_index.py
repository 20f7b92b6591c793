"""Benchmark decontamination by a distributed positional inverted index.

The index is a table in the shared folder. Documents are dealt into blocks of
bounded text, a longer text being a block by itself, and a block numbers its
words; one unused number parts two documents, so a run of words never reaches
over a border. A row holds a block's postings of one word: the places where it
stands, rising. One more row per block, without a word, holds its documents.

Phrases (windows of item words) are found from their rarest word on. Words are
counted over the whole index; a phrase with a word that occurs nowhere is
dropped. A phrase goes to the blocks that hold its rarest word. There the lists
of that block meet: places of the rarest word, less its offset, are the
candidates, and the lists of the other words, moved by their offsets and taken
from rare to frequent, leave the exact matches. A word's postings are split by
block, so a word in every document is as many bounded lists as there are blocks,
and documents are whole in their block, so no result of a document is gathered
from several tasks.

Proximity: an item's phrase is near if every word of it stands at most ``within``
words from one occurrence of its rarest word, in any order, in one document.

Words are compared by 64-bit names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopscope.llm.shared import importable, written
from shopscope.llm.words import alnum_texts, text_batches, word_names
from shopscope.plans.marks import marks, with_mark

WINDOW = 10
#: Text bytes of a block: bounds the lists that meet in a task.
BLOCK_BYTES = 4_000_000
#: Candidate places that one step of a search holds at a time.
STEP = 1_000_000

INDEX = "block long, name long, n long, places binary, doc_ids array<long>, n_words array<long>"
_LONG, _PLACE = np.dtype("<i8"), np.dtype("<u4")


def _names(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    names, bounds = word_names(alnum_texts(texts))
    return names.view(np.int64), bounds


def positional_index(docs: DataFrame, text: str = "text") -> DataFrame:
    """The index of all texts as a written table. Per block and word: ``n`` places (unsigned 32-bit
    numbers); per block without a word (name null): the places where its documents begin, their
    ``doc_ids`` and ``n_words``. Null and empty texts are documents without words."""
    importable(docs.sparkSession)
    from pyspark import TaskContext

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32  # any unique numbers do: they are written once
        for b in text_batches(batches, limit=BLOCK_BYTES):
            names, bounds = _names(b.column("text"))
            counts = np.diff(bounds)
            places = (np.arange(len(names)) + np.repeat(np.arange(b.num_rows), counts)).astype(_PLACE)
            begins = (bounds[:-1] + np.arange(b.num_rows)).astype(_PLACE)
            order = np.argsort(names, kind="stable")
            names, raw = names[order], places[order].tobytes()
            cuts = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1]))) if len(names) else np.zeros(0, dtype=np.int64)
            n = np.diff(np.append(cuts, len(names)))
            ends = np.append(cuts, len(names)) * _PLACE.itemsize
            lists = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(raw)]).cast(pa.binary())
            none = pa.nulls(len(cuts), pa.list_(pa.int64()))
            fields = ["block", "name", "n", "places", "doc_ids", "n_words"]
            yield pa.record_batch([pa.array(np.full(len(cuts), block)), pa.array(names[cuts]), pa.array(n), lists, none, none], names=fields)
            yield pa.record_batch([
                pa.array([block]), pa.array([None], pa.int64()), pa.array([b.num_rows]), pa.array([begins.tobytes()], pa.binary()),
                pa.array([b.column("doc_id").to_pylist()], pa.list_(pa.int64())), pa.array([counts.tolist()], pa.list_(pa.int64()))], names=fields)
            block += 1

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return written(rows.mapInArrow(build, INDEX), "phrase-index")


def phrases(items: DataFrame, window: int = WINDOW, text: str = "text") -> DataFrame:
    """(phrase, names, items): each different run of ``window`` words of the items, or all words of a
    shorter one, with the ids (as strings, a null id as the empty one) of the items that have it."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches, limit=BLOCK_BYTES):
            names, bounds = _names(b.column("text"))
            ids = b.column("item_id").to_pylist()
            out = []
            for item, a, e in zip(ids, bounds[:-1].tolist(), bounds[1:].tolist()):
                out += [(item, names[i:min(i + window, e)].astype(_LONG).tobytes()) for i in range(a, max(e - window, a) + 1)] if e > a else []
            yield pa.record_batch({"item_id": pa.array([x for x, _ in out], pa.string()), "names": pa.array([x for _, x in out], pa.binary())})

    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col(text).cast("string").alias("text"))
    runs = rows.mapInArrow(cut, "item_id string, names binary")
    grouped = runs.groupBy("names").agg(F.collect_set("item_id").alias("items"))
    return grouped.select(F.monotonically_increasing_id().alias("phrase"), "names", "items")


def _words(wanted: DataFrame) -> DataFrame:
    """(phrase, offset, name) of the words of each phrase."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [np.frombuffer(x, dtype=_LONG) for x in b.column("names").to_pylist()]
            sizes = np.array([len(x) for x in parts], dtype=np.int64)
            yield pa.record_batch({
                "phrase": pa.array(np.repeat(b.column("phrase").to_numpy(), sizes)),
                "offset": pa.array(np.concatenate([np.arange(s) for s in sizes.tolist()] or [np.zeros(0, dtype=np.int64)]).astype(np.int32)),
                "name": pa.array(np.concatenate(parts or [np.zeros(0, dtype=_LONG)]))})

    return wanted.select("phrase", "names").mapInArrow(each, "phrase long, offset int, name long")


def rarest_first(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """(phrase, items, anchor, offsets, names): the phrases all of whose words occur in the index, their
    words from rare to frequent and ``anchor``, the rarest one."""
    words = _words(wanted)
    counts = _postings_of(index, words, "name").groupBy("name").agg(F.sum("n").alias("n"))
    ordered = words.join(counts, "name", "left").groupBy("phrase").agg(
        F.array_sort(F.collect_list(F.struct("n", "offset", "name"))).alias("w"), F.count_if(F.col("n").isNull()).alias("missing"))
    ordered = ordered.filter("missing = 0").select("phrase", F.expr("w[0].name").alias("anchor"), F.col("w.offset").alias("offsets"), F.col("w.name").alias("names"))
    return wanted.select("phrase", "items").join(ordered, "phrase")


def _postings_of(index: DataFrame, words: DataFrame, name: str) -> DataFrame:
    """The postings of these words, and maybe of others: a bitmap of fixed size is what the postings meet.
    A join on the word would bring all lists of a frequent word into one task."""
    postings = index.filter("name is not null").select("block", "name", "n", "places")
    return with_mark(postings, F.col("name"), marks(words, name)).where("_marked").drop("_marked")


class _Block:
    """The lists of one block: all its places, keyed by word and place, in one sorted array."""

    def __init__(self, lists: pa.Table):
        lists = lists.sort_by("name")
        self.names = lists.column("name").to_numpy()
        sizes = lists.column("n").to_numpy()
        self.first = np.concatenate(([0], np.cumsum(sizes)))
        raw = b"".join(lists.column("places").to_pylist())
        self.places = np.frombuffer(raw, dtype=_PLACE).astype(np.int64)
        self.keys = (np.repeat(np.arange(len(sizes)), sizes) << 32) | self.places

    def rank(self, names: np.ndarray) -> np.ndarray:
        """Which list each word has, -1 for none."""
        at = np.minimum(np.searchsorted(self.names, names), max(len(self.names) - 1, 0))
        return np.where(self.names[at] == names, at, -1) if len(self.names) else np.full(len(names), -1)

    def holds(self, rank: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether each list has a place in low..high (bounds included)."""
        at = np.searchsorted(self.keys, rank << 32 | np.maximum(low, 0))
        there = self.keys[np.minimum(at, len(self.keys) - 1)]
        return (at < len(self.keys)) & (rank >= 0) & (there <= (rank << 32 | high)) & (high >= 0)

    def candidates(self, rank: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(phrase, place of its rarest word) in steps of bounded size; a list is cut where need be."""
        sizes = np.where(rank >= 0, self.first[rank + 1] - self.first[rank], 0)
        ends = np.cumsum(sizes)
        for a in range(0, int(ends[-1]) if len(ends) else 0, STEP):
            i = np.arange(a, min(a + STEP, int(ends[-1])))
            which = np.searchsorted(ends, i, side="right")
            yield which, self.places[self.first[rank[which]] + i - (ends[which] - sizes[which])]


def exact(block: _Block, ranks: list[np.ndarray], offsets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, place of its first word) of all exact matches: ``ranks[j]``, ``offsets[j]`` are the list
    and the offset of every phrase's j-th rarest word (rank -2: the phrase has fewer words)."""
    found = []
    for which, place in block.candidates(ranks[0]):
        start = place - offsets[0][which]
        for rank, offset in zip(ranks[1:], offsets[1:]):
            at = start + offset[which]
            keep = (rank[which] == -2) | block.holds(rank[which], at, at)
            which, start = which[keep], start[keep]
        found.append((which[start >= 0], start[start >= 0]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def near(block: _Block, ranks: list[np.ndarray], begins: np.ndarray, ends: np.ndarray, within: int) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, place of its rarest word) where every other word stands at most ``within`` words away, in
    the same document."""
    found = []
    for which, place in block.candidates(ranks[0]):
        for rank in ranks[1:]:
            doc = np.searchsorted(begins, place, side="right") - 1
            keep = (rank[which] == -2) | block.holds(rank[which], np.maximum(place - within, begins[doc]), np.minimum(place + within, ends[doc] - 1))
            which, place = which[keep], place[keep]
        found.append((which, place))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _merged(start: np.ndarray, end: np.ndarray) -> list[dict]:
    """Spans as they come in order of their start, joined where they touch."""
    if not len(start):
        return []
    far = np.maximum.accumulate(end)
    new = np.concatenate(([True], start[1:] > far[:-1]))
    last = np.append(np.flatnonzero(new)[1:] - 1, len(start) - 1)
    return [{"from": a, "until": b} for a, b in zip(start[new].tolist(), far[last].tolist())]


MATCHES = "doc_id long, n_words long, spans array<struct<from: long, until: long>>, items array<string>, near_items array<string>"


def matches(index: DataFrame, wanted: DataFrame, within: int | None = None) -> DataFrame:
    """One row per document of the index: doc_id, n_words, ``spans`` of words inside exact matches (from 0,
    end excluded, in order, apart), ``items`` with an exact match and ``near_items`` with a phrase whose
    words stand near each other (empty unless ``within`` is given), both sorted as strings.

    Documents without words or matches have empty lists. Repeated documents are separate rows. An empty
    index gives an empty result, no phrases give empty lists.
    """
    wanted = written(rarest_first(index, wanted), "phrases")
    lists = _postings_of(index, wanted.select(F.explode("names").alias("name")), "name")
    heads = index.filter("name is null").select("block", "name", "n", "places", "doc_ids", "n_words")
    left = heads.unionByName(lists, allowMissingColumns=True)
    # a phrase goes where its rarest word is
    where = _postings_of(index, wanted, "anchor").select(F.col("block").alias("to_block"), F.col("name").alias("anchor"))
    to = where.join(wanted, "anchor").select("to_block", "items", "offsets", "names")
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("spans", pa.list_(pa.struct([("from", pa.int64()), ("until", pa.int64())]))),
                        ("items", pa.list_(pa.string())), ("near_items", pa.list_(pa.string()))])

    def search(lists: pa.Table, asked: pa.Table) -> pa.Table:
        import pyarrow.compute as pc

        no_name = pc.is_null(lists.column("name"))
        head = lists.filter(no_name).to_pylist()[0]
        begins, n_words = np.frombuffer(head["places"], dtype=_PLACE).astype(np.int64), np.array(head["n_words"], dtype=np.int64)
        spans = [[] for _ in range(len(begins))]
        items, close = [[] for _ in spans], [[] for _ in spans]
        if asked.num_rows:
            block = _Block(lists.filter(pc.invert(no_name)).select(["name", "n", "places"]))
            names, offsets = asked.column("names").combine_chunks(), asked.column("offsets").combine_chunks()
            sizes, first = np.diff(names.offsets.to_numpy()), names.offsets.to_numpy()[:-1] - names.offsets.to_numpy()[0]
            rank, offset = block.rank(names.flatten().to_numpy()), offsets.flatten().to_numpy().astype(np.int64)
            ranks, shifts = [], []
            for j in range(int(sizes.max())):
                at = np.minimum(first + j, len(rank) - 1)
                ranks.append(np.where(j < sizes, rank[at], -2))
                shifts.append(np.where(j < sizes, offset[at], 0))
            of_phrase = asked.column("items").to_pylist()
            which, start = exact(block, ranks, shifts)
            doc = np.searchsorted(begins, start, side="right") - 1
            order = np.argsort(start, kind="stable")
            which, start, doc = which[order], start[order] - begins[doc[order]], doc[order]
            cuts = np.searchsorted(doc, np.arange(len(begins) + 1))
            for d in np.unique(doc).tolist():
                w, s = which[cuts[d]:cuts[d + 1]], start[cuts[d]:cuts[d + 1]]
                spans[d] = _merged(s, s + sizes[w])
                items[d] = sorted({i for p in np.unique(w).tolist() for i in of_phrase[p]})
            if within is not None:
                which, place = near(block, ranks, begins, begins + n_words, within)
                doc = np.searchsorted(begins, place, side="right") - 1
                for d, p in np.unique(np.stack([doc, which]), axis=1).T.tolist():
                    close[d] = close[d] + of_phrase[p]
                close = [sorted(set(x)) for x in close]
        return pa.table([pa.array(head["doc_ids"], pa.int64()), pa.array(n_words), pa.array(spans, schema.field("spans").type),
                         pa.array(items, schema.field("items").type), pa.array(close, schema.field("near_items").type)], schema=schema)

    return left.groupBy("block").cogroup(to.groupBy("to_block")).applyInArrow(search, MATCHES)


def hit_words(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["until"] - s["from"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, within: int | None = None) -> DataFrame:
    """``matches`` of the benchmark's phrases in all documents."""
    index = positional_index(docs)
    return matches(index, written(phrases(benchmark, window), "windows"), within)
