"""Jaccard join of documents on word shingles by T-occurrence search.

Two sets link when their overlap reaches T, which the threshold and their sizes
give. The steps:

1. ``profiles`` (one pass) names every document's shingle set, so equal sets
   become one vertex, and finds shingles that many documents hold.
2. Short lists first: shingles are ordered rare before frequent, and a set of n
   is listed only under its first n - T + c shingles. Sets that reach T share
   at least c of those lists (``COMMON``); the remaining, longer lists are
   never built over the corpus. Lists of one set go at once: a bitmap of fixed
   size keeps most of their rows from being shuffled again.
3. A set that shares fewer than c lists with others cannot link and goes; then
   lists of one set go again. Linked sets share half of c in lists of at most
   ``FEW`` sets or half of c in longer ones. Pairs that share so many of the
   former are counted; members of the latter, which can be large groups, are
   only tied to one of the list. Sets tied directly or through others form a
   cell: all links lie within cells.
4. Cells are dealt to tasks of bounded size. A task indexes its sets and
   answers a query per set by DivideSkip: the longest lists are set aside, the
   short ones merged in order and counted, and candidates that can still reach
   T are looked up in the long lists by binary search. Only links that join
   two groups leave a task, so m near copies give m rows at most, not m².
5. A cell above ``CELL`` sets is cut into blocks. Sets that a block alone has
   connected with most of the cell are settled; only the others are queries to
   the other blocks.

A set's name is the sum of its scrambled shingles; all names have 64 bits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopscope.llm.components import components
from shopscope.llm.shared import bitmap, made, numbered, parted, passes, removed, small_batches, stored, unused, written
from shopscope.llm.words import U, mix, text_batches, window_names, word_names

SHINGLE = 5
PERCENT = 75
#: Shingles ordered last because many documents hold them; any order gives the same links.
FREQUENT = 1 << 17
#: A shingle is counted where this many sets of one batch hold it.
FREQUENT_IN_BATCH = 3
#: Members of a list whose pairs are counted.
FEW = 24
#: Sets of a task, and of a block of a larger cell.
CELL = 2000
#: Weight of list lengths in the number of lists set aside, T / (MU * log2(longest) + 1). Merging is
#: cheap against looking up here, so fewer are set aside than with disk lists.
MU = 5.0


#: Two linked sets share at least this fraction (1 / COMMON) of their T in lists; one list at least.
COMMON = 12
#: Bits of the filters for shared lists and for sets to recompute (8 MB and 1 MB).
LIST_BITS, SET_BITS = 1 << 26, 1 << 23
LOW = (1 << 32) - 1


def needed(n: np.ndarray | int, percent: int = PERCENT):
    """Least overlap of a set of n with any set it links to."""
    return -(-percent * n // 100)


def shingle_sets(texts: pa.Array, k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle names of each text; a shorter text is one shingle, an empty one none."""
    names, bounds = word_names(texts, lower=True)
    at = window_names(names, k)
    sets = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= k:
            s = np.sort(at[a:b - k + 1])
            sets.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif b > a:
            sets.append(mix(window_names(names[a:b], b - a) + U(b - a)))
        else:
            sets.append(np.zeros(0, dtype=U))
    return sets


def set_names(sets: list[np.ndarray]) -> np.ndarray:
    sums = np.array([mix(s + U(1)).sum() for s in sets], dtype=U)
    return mix(sums + np.array([len(s) for s in sets], dtype=U)).view(np.int64)


def profiles(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """A row per document (its set's name and size; no name without words), and rows without
    ``row`` for shingles that several sets of a batch hold (name and count)."""

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches):
            sets = shingle_sets(b.column("text"), k)
            names, sizes = set_names(sets), np.array([len(s) for s in sets], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("doc_id"), pa.array(names, mask=sizes == 0), pa.array(sizes)], ["row", "doc_id", "name", "n"])
            first = np.unique(names, return_index=True)[1]
            held, n = np.unique(np.concatenate([sets[i] for i in first]), return_counts=True)
            often = n >= FREQUENT_IN_BATCH
            held, n = held[often].view(np.int64), n[often].astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(n), pa.int64()), pa.nulls(len(n), pa.int64()), pa.array(held), pa.array(n)], ["row", "doc_id", "name", "n"])

    return docs.mapInArrow(profile, "row long, doc_id long, name long, n long")


def short_lists(docs: DataFrame, frequent: np.ndarray, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(shingle, name, n): each set under the first n - T + c of its shingles, rare first.
    ``frequent``: shingle names, most frequent first."""
    order = np.argsort(frequent)
    sorted_names = frequent[order]

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches):
            sets = shingle_sets(b.column("text"), k)
            names = set_names(sets)
            shingles, owners, sizes = [], [], []
            for i in np.unique(names, return_index=True)[1].tolist():
                s = sets[i]
                n = len(s)
                if not n:
                    continue
                t = needed(n, percent)
                p = n - t + max(1, t // COMMON)
                if len(sorted_names):
                    at = np.minimum(np.searchsorted(sorted_names, s), len(sorted_names) - 1)
                    often = np.flatnonzero(sorted_names[at] == s)
                    if len(often):
                        rest = np.delete(s, often)
                        s = rest if len(rest) >= p else np.concatenate([rest, s[often][np.argsort(-order[at[often]], kind="stable")]])
                shingles.append(s[:p])
                owners.append(np.full(p, names[i]))
                sizes.append(np.full(p, n))
            if shingles:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(shingles).view(np.int64)), pa.array(np.concatenate(owners)), pa.array(np.concatenate(sizes).astype(np.int32))], ["shingle", "name", "n"])

    return docs.select("text").mapInArrow(lists, "shingle long, name long, n int")


class DivideSkip:
    """T-occurrence search over the sets of one task."""

    def __init__(self, sets: list[np.ndarray], percent: int = PERCENT):
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        self.percent = percent
        flat = np.concatenate(sets) if sets else np.zeros(0, dtype=U)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(flat, kind="stable")  # owners ascend within a list
        self.owners = owner[order]
        flat = flat[order]
        self.starts = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1]))) if len(flat) else np.zeros(0, dtype=np.int64)
        self.shingles = flat[self.starts]
        self.ends = np.append(self.starts[1:], len(flat))

    def search(self, query: np.ndarray, labels: np.ndarray | None = None, own: int = -1) -> np.ndarray:
        """Places of all indexed sets that link with the query; with ``labels``, of those not labelled ``own``."""
        n = len(query)
        at = np.searchsorted(self.shingles, query)
        at = at[at < len(self.shingles)] if len(at) and at[-1] == len(self.shingles) else at
        at = at[self.shingles[at] == query[:len(at)]]
        t = int(needed(n, self.percent))
        if len(at) < t:
            return at[:0]
        length = self.ends[at] - self.starts[at]
        by = np.argsort(-length, kind="stable")
        at, length = at[by], length[by]
        longest = int(length[0])
        n_long = min(t - 1, int(t / (MU * math.log2(longest) + 1))) if longest > 1 else 0
        short = at[n_long:]
        # merge of the short lists: their runs in order of owner
        size = length[n_long:]
        ends = np.cumsum(size)
        place = np.repeat(self.starts[short] - (ends - size), size) + np.arange(int(ends[-1]))
        found, count = np.unique(self.owners[place], return_counts=True)
        keep = count >= t - n_long
        if labels is not None:
            keep &= labels[found] != own
        found, count = found[keep], count[keep]
        for i, a in enumerate(at[:n_long].tolist()):
            if not len(found):
                break
            members = self.owners[self.starts[a]:self.ends[a]]
            spot = np.minimum(np.searchsorted(members, found), len(members) - 1)
            count = count + (members[spot] == found)
            keep = count >= t - (n_long - 1 - i)
            found, count = found[keep], count[keep]
        return found[100 * count >= self.percent * (n + self.sizes[found] - count)]


def connecting(index: list[np.ndarray], queries: list[np.ndarray], labels: np.ndarray, percent: int = PERCENT) -> list[tuple[int, int]]:
    """(query, indexed set) for each link that joins two groups of sets. ``labels``: the group of
    every indexed set and then of every query; equal labels are one group from the start."""
    found, labels, out, n = DivideSkip(index, percent), labels.copy(), [], len(index)
    for q, query in enumerate(queries):
        for hit in found.search(query, labels, labels[n + q]).tolist():
            a, b = labels[hit], labels[n + q]
            if a != b:
                out.append((q, hit))
                labels[labels == max(a, b)] = min(a, b)
    return out


def _arrays(column) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), dtype=U) for c in column.chunks for x in c]


def within_tasks(placed: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) that connect the sets of each task (task, name, shingles)."""

    def search(t: pa.Table) -> pa.Table:
        sets, names = _arrays(t.column("shingles")), t.column("name").to_numpy()
        # a set is in the group of its query from the start
        links = connecting(sets, sets, np.tile(np.arange(len(sets)), 2), percent)
        return pa.table({"a": pa.array([names[q] for q, _ in links], pa.int64()), "b": pa.array([names[i] for _, i in links], pa.int64())})

    return placed.groupBy("task").applyInArrow(search, "a long, b long")


def across_blocks(index: DataFrame, queries: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) between the sets of a pair's index and queries (pair, name, label, shingles)."""

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        names, asked = left.column("name").to_numpy(), right.column("asked").to_numpy()
        if not len(names) or not len(asked):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        groups = np.unique(np.concatenate([left.column("label").to_numpy(), right.column("asked_label").to_numpy()]), return_inverse=True)[1]
        links = connecting(_arrays(left.column("shingles")), _arrays(right.column("asked_shingles")), groups, percent)
        return pa.table({"a": pa.array([asked[q] for q, _ in links], pa.int64()), "b": pa.array([names[i] for _, i in links], pa.int64())})

    queries = queries.select(F.col("pair").alias("of"), F.col("name").alias("asked"), F.col("label").alias("asked_label"), F.col("shingles").alias("asked_shingles"))
    return index.groupBy("pair").cogroup(queries.groupBy("of")).applyInArrow(search, "a long, b long")


def sets_of(docs: DataFrame, wanted: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(name, shingles as bytes) of the sets of the wanted rows, and of a few more; nothing is shuffled."""
    bits = bitmap(wanted, "row", SET_BITS)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for some in text_batches([b.filter(pa.array(passes(bits, b.column("row").to_numpy())))]):
                found = shingle_sets(some.column("text"), k)
                yield pa.RecordBatch.from_arrays([pa.array(set_names(found)), pa.array([s.tobytes() for s in found], type=pa.binary())], ["name", "shingles"])

    return docs.select("row", "text").mapInArrow(sets, "name long, shingles binary")


def listed_together(lists: DataFrame) -> tuple[DataFrame, str]:
    """Rows of lists that at least two sets share, and the folder that they are read from."""
    # the low half of a name is enough for the filter, and half as much to shuffle
    held = lists.select(F.expr("cast(shiftright(shiftleft(shingle, 32), 32) as int)").alias("low")).groupBy("low").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    bits = bitmap(held.select(F.expr(f"cast(low as long) & {LOW}L").alias("low")), "low", LIST_BITS)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(passes(bits, b.column("shingle").to_numpy() & LOW)))

    rows, at = stored(lists.mapInArrow(keep, "shingle long, name long, n int").distinct(), "filtered-lists")
    shared = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("held")).filter("held > 1").select("shingle")
    return rows.join(shared, "shingle"), at


def _common(n: str, percent: int) -> Column:
    """Lists that a set of n shares with any set it links to."""
    return F.greatest(F.lit(1), F.expr(f"(({percent} * {n} + 99) div 100) div {COMMON}"))


def linkable(members: DataFrame, at: str, percent: int) -> tuple[DataFrame, str]:
    """Members of lists that can still link: in enough lists, and these with others; with the
    members (``held``) and the least name (``a``) of their list. Also the folder that they are read
    from; the one of the given members goes. Each join is stored: a plan of all of them would repeat
    what comes before in every branch, 15 broadcasts in place of 4."""
    spark = members.sparkSession
    for _ in range(2):
        enough = members.groupBy("name", "n").agg(F.count(F.lit(1)).alias("lists")).filter(F.col("lists") >= _common("n", percent)).select("name")
        some, some_at = stored(members.select("shingle", "name", "n").join(enough, "name", "left_semi"), "members-in-lists")
        removed(spark, at)
        shared = some.groupBy("shingle").agg(F.count(F.lit(1)).alias("held"), F.min("name").alias("a")).filter("held > 1")
        members, at = stored(some.join(shared, "shingle"), "linkable-members")
        removed(spark, some_at)
    return members, at


def cells_of(members: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(name, cell): sets that may link, directly or through others."""
    half = lambda *n: F.ceil(F.least(*(_common(x, percent) for x in n)) / 2) if len(n) > 1 else F.ceil(_common(n[0], percent) / 2)
    few = members.filter(F.col("held") <= FEW)
    other = few.select("shingle", F.col("name").alias("b"), F.col("n").alias("n_b"))
    both = few.select("shingle", "name", "n").join(other, "shingle").filter((F.col("name") < F.col("b")) & (F.least("n", "n_b") * 100 >= F.greatest("n", "n_b") * percent))
    pairs = both.groupBy("name", "b", "n", "n_b").agg(F.count(F.lit(1)).alias("lists")).filter(F.col("lists") >= half("n", "n_b"))
    many = members.filter(F.col("held") > FEW)
    enough = many.groupBy("name", "n").agg(F.count(F.lit(1)).alias("lists")).filter(F.col("lists") >= half("n")).select("name")
    tied = many.join(enough, "name", "left_semi")
    first = tied.groupBy("shingle").agg(F.min("name").alias("first"))
    ties = tied.select("shingle", "name").join(first, "shingle").filter("name != first").select("first", "name").distinct()
    edges = pairs.select(F.col("name").alias("a"), "b").union(ties.select(F.col("first").alias("a"), F.col("name").alias("b")))
    return components(edges).select(F.col("id").alias("name"), F.col("component").alias("cell"))


def links_of(cells: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect all sets of a cell that are linked through others."""
    sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("m"))
    tasks = max(1, cells.count() // CELL)
    block = F.when(F.col("m") > CELL, F.pmod(F.xxhash64("name"), F.ceil(F.col("m") / CELL))).otherwise(F.lit(0).cast("long"))
    # small cells share a task, a block of a large one has its own
    task = F.when(F.col("m") > CELL, F.xxhash64("cell", "block")).otherwise(F.pmod(F.xxhash64("cell"), F.lit(tasks)))
    placed = cells.join(sizes, "cell").withColumn("block", block).withColumn("task", task)
    placed = written(placed.join(sets, "name").dropDuplicates(["name"]), "cell-sets")
    links = written(within_tasks(placed.select("task", "name", "shingles"), percent), "links")
    large = placed.filter(F.col("m") > CELL)
    if large.isEmpty():
        return links
    labels = components(links).select(F.col("id").alias("name"), F.col("component").alias("found"))
    labelled = large.join(labels, "name", "left").withColumn("label", F.coalesce("found", "name")).select("cell", "block", "name", "label", "shingles")
    labelled = written(labelled, "labelled-sets")
    groups = labelled.groupBy("cell", "label").agg(F.count(F.lit(1)).alias("size"))
    most = groups.groupBy("cell").agg(F.max("size").alias("size")).join(groups, ["cell", "size"]).groupBy("cell").agg(F.min("label").alias("most"))
    asking = labelled.join(most, "cell").filter("label != most").select("cell", F.col("block").alias("from"), "name", "label", "shingles")
    blocks = labelled.select("cell", "block").distinct()
    froms = asking.select("cell", "from").distinct()
    pairs = blocks.join(froms, "cell").filter(F.col("block") != F.col("from")).withColumn("pair", F.xxhash64("cell", "block", "from"))
    index = labelled.join(pairs, ["cell", "block"]).select("pair", "name", "label", "shingles")
    queries = asking.join(pairs, ["cell", "from"]).select("pair", "name", "label", "shingles")
    return links.union(written(across_blocks(index, queries, percent), "block-links"))


def components_of_rows(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(row, doc_id, n_shingles, component_id, c): every row of ``docs``, the smallest doc_id that
    links lead to, and the component's name, null without shingles; ``row`` is
    its number in ``numbered`` rows.

    Texts without words, null ones too, have no shingles and link with nothing: their component
    is their own doc_id. Rows with equal sets link. A null doc_id takes part but is the smallest
    only where there is no other. Repeated rows stay. An empty table gives an empty result. Other
    columns are ignored.
    """
    return _components_of_numbered(numbered(docs, "row", F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), k, percent)


def _components_of_numbered(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """``components_of_rows`` over (row, doc_id, text)."""
    spark = docs.sparkSession
    small_batches(spark)
    seen = written(profiles(docs, k), "shingle-profiles")
    rows = seen.filter("row is not null").select("row", "doc_id", "name", "n")
    often = seen.filter("row is null").groupBy("name").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "name").limit(FREQUENT)
    frequent = often.select("name").toArrow().column("name").to_numpy().view(U)  # FREQUENT names at most, in order

    vertices = rows.filter("name is not null").groupBy("name").agg(F.min("doc_id").alias("doc_id"), F.min("row").alias("row"))

    def grouped_sets() -> DataFrame:
        # each table of lists goes when the next one is written
        lists, lists_at = stored(short_lists(docs, frequent, k, percent), "short-lists")
        together, together_at = listed_together(lists)
        removed(spark, lists_at)
        members, members_at = stored(together, "list-members")
        removed(spark, together_at)
        linked, linked_at = linkable(members, members_at, percent)
        cells = written(cells_of(linked, percent), "cells")
        removed(spark, linked_at)
        sets = sets_of(docs, cells.join(vertices, "name"), k)
        return components(links_of(cells, sets, percent))

    labels = made(spark, "components", grouped_sets)
    joined = vertices.join(labels.withColumnRenamed("id", "name"), "name", "left").select("name", F.coalesce("component", "name").alias("c"), "doc_id")
    classes = joined.join(joined.groupBy("c").agg(F.min("doc_id").alias("component_id")), "c").select("name", "c", "component_id")
    alone = rows.filter("name is null").select("row", "doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("c"))
    grouped = rows.filter("name is not null").join(classes, "name").select("row", "doc_id", F.col("n").alias("n_shingles"), "component_id", "c")
    return grouped.union(alone)


def ngram_components(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs``; see ``components_of_rows``."""
    return components_of_rows(docs, k, percent).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without all but one of each component: the smallest doc_id, of equal
    ones the first row. Texts without words stay."""
    own = unused(docs, "group_row")
    rows = numbered(docs, own)
    texts = rows.select(F.col(own).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def copies() -> DataFrame:
        found = written(_components_of_numbered(texts, k, percent), "row-components")
        first = found.filter(F.col("c").isNotNull() & F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("c").agg(F.min("row").alias("row"))
        # by row: a component can be large
        return found.filter("c is not null").select("row").join(first, "row", "left_anti").select(F.col("row").alias(own))

    go = made(docs.sparkSession, "rows-that-go", copies)
    # only texts that may go are shuffled
    may, stay = parted(rows, own, go)
    return may.join(go, own, "left_anti").union(stay).select(*docs.columns)
