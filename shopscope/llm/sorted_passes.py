"""Near-duplicate vectors by sorted projection passes.

Equal vectors become one vertex. Each pass gives every vector the concatenated
signs of its products with the pass's random directions, sorts all vectors by
that name, and compares each with its next ``WINDOW`` neighbours; pairs with
cosine of at least the threshold are links. Vectors whose names agree on the
first ``prefix_bits`` form a group; a pair in one group always meets: groups of
at most ``WINDOW`` + 1 vectors stay in one task, and larger ones, which dense
regions make, are counted and, where links don't unite them yet, compared as a
whole, block by block. The number of passes follows the number of bits, so a
pair at the threshold is in different groups of all passes with probability
``MISS`` at most, however dense its surroundings are.

Links of all passes are united to components. The window bounds what a pass
compares, not what is counted: inside each component every vector's links are
then counted against all members. Components above ``BLOCK`` vectors are cut
into rings around one member by angle. Two rings that the triangle inequality
settles need no comparison; the others are compared block by block, and only
counts leave a task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopscope.llm.components import components
from shopscope.llm.shared import bitmap, written
from shopscope.llm.shared import passes as passes_bitmap
from shopscope.llm.vectors import matrix, unit, usable

COSINE = 0.95
WINDOW = 32
BITS = 62
MISS = 1e-4
#: Places of the bitmap of crowded groups.
CROWDED_BITS = 1 << 23
#: Members that one task compares with as many others.
BLOCK = 2000
#: Rings by angle, over half a turn.
RINGS = 80
SEED = 20


def prefix_bits(n: int, window: int = WINDOW) -> int:
    """Bits of a name that make a group: n evenly spread vectors fill half a window at most."""
    return min(40, max(1, math.ceil(math.log2(max(n, 1) / window))) + 1)


def passes_for(n: int, cosine: float = COSINE, window: int = WINDOW, miss: float = MISS) -> int:
    """Passes after which a pair at the threshold has been missed with probability ``miss``."""
    meet = (1 - math.acos(cosine) / math.pi) ** prefix_bits(n, window)
    return max(4, math.ceil(math.log(miss) / math.log(1 - min(meet, 0.999))))


def _directions(dim: int, one_pass: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim, one_pass]).standard_normal((dim, BITS))


def pass_names(vectors: DataFrame, passes: int, bits: int, crowded: np.ndarray | None = None, wide: bool = True) -> DataFrame:
    """A row per vector and pass: its name in the pass, its group, and whether the bitmap ``crowded``
    has the group; the vector if ``wide``, else only rows of such groups (all without a bitmap)."""
    shared = vectors.sparkSession.sparkContext.broadcast(crowded)  # CROWDED_BITS
    columns = ["pass", "dim", "key", "name", "group", "crowded", *(["v"] if wide else [])]

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(BITS, dtype=np.int64)[::-1]
        for b in batches:
            dims = b.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                rows = b.filter(pa.array(dims == dim))
                x = unit(matrix(rows.column("v")))
                for p in range(passes):
                    key = ((x @ _directions(dim, p)) > 0) @ weights
                    n = np.full(len(rows), p, dtype=np.int32)
                    # one number per pass and prefix (odd factors lose nothing), scattered for the bitmap
                    group = (np.int64(p) << 42 | key >> (BITS - bits)).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    group = group.view(np.int64)
                    full = passes_bitmap(shared.value, group) if shared.value is not None else np.ones(len(rows), dtype=bool)
                    out = pa.RecordBatch.from_arrays([pa.array(n), rows.column("dim"), pa.array(key), rows.column("name"), pa.array(group), pa.array(full), *([rows.column("v")] if wide else [])], columns)
                    yield out if wide else out.filter(pa.array(full))

    kind = "pass int, dim int, key long, name long, group long, crowded boolean"
    return vectors.select("name", "dim", "v").mapInArrow(names, kind + (f", v {dict(vectors.dtypes)['v']}" if wide else ""))


def crowded_groups(vectors: DataFrame, passes: int, bits: int, window: int = WINDOW) -> np.ndarray:
    """Bitmap of the groups that a window doesn't hold."""
    groups = pass_names(vectors, passes, bits, wide=False).groupBy("dim", "group").agg(F.count(F.lit(1)).alias("n"))
    return bitmap(groups.filter(F.col("n") > window + 1).select("group"), "group", CROWDED_BITS)


def window_links(named: DataFrame, bits: int, cosine: float = COSINE, window: int = WINDOW) -> DataFrame:
    """Links (a, b) that connect all pairs in each other's window with enough cosine. A pair is
    left out where links between direct neighbours already connect it."""

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        for b in batches:
            group = np.stack([b.column("pass").to_numpy(), b.column("dim").to_numpy()], axis=1)
            cuts = np.flatnonzero((group[1:] != group[:-1]).any(axis=1)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(group)]):
                if hi == lo:
                    continue
                of = tuple(group[lo].tolist())
                x = unit(matrix(b.column("v").slice(lo, hi - lo)))
                name = b.column("name").slice(lo, hi - lo).to_numpy()
                if of in held:  # the last window of the batch before
                    x, name = np.concatenate([held[of][0], x]), np.concatenate([held[of][1], name])
                held = {of: (x[-window:], name[-window:])}
                next_links = np.append((x[:-1] * x[1:]).sum(axis=1) >= cosine, False)
                breaks = np.cumsum(~next_links)
                a, c = [name[:-1][next_links[:-1]]], [name[1:][next_links[:-1]]]
                for o in range(2, min(window, len(x) - 1) + 1):
                    apart = np.flatnonzero(breaks[o - 1:len(x) - 1] - np.concatenate(([0], breaks))[:len(x) - o] > 0)
                    hit = apart[(x[apart] * x[apart + o]).sum(axis=1) >= cosine]
                    a.append(name[hit])
                    c.append(name[hit + o])
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(c))], ["a", "b"])

    order = ["pass", "dim", "key", "name"]
    # a group that the window holds is not cut by a border between tasks
    first = F.expr(f"key - pmod(key, {1 << (BITS - bits)}L)")
    borders = ["pass", "dim", F.when(F.col("crowded"), F.col("key")).otherwise(first), F.when(F.col("crowded"), F.col("name")).otherwise(F.lit(0))]
    return named.repartitionByRange(*borders).sortWithinPartitions(*order).mapInArrow(links, "a long, b long").distinct()


def _united(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j): links that connect what the symmetric matrix ``hit`` connects, one per row at most."""
    seen = np.zeros(len(hit), dtype=bool)
    i, j = [], []
    for start in np.flatnonzero(hit.any(axis=1)).tolist():
        if seen[start]:
            continue
        seen[start] = True
        front = np.array([start])
        while len(front):
            front = np.flatnonzero(hit[front].any(axis=0) & ~seen)
            seen[front] = True
            i.append(np.full(len(front), start))
            j.append(front)
    flat = lambda xs: np.concatenate(xs) if xs else np.zeros(0, dtype=np.int64)
    return flat(i), flat(j)


def crowded_links(vectors: DataFrame, rows: DataFrame, labels: DataFrame, cosine: float = COSINE) -> DataFrame:
    """Links (a, b) that connect all pairs with enough cosine in groups (dim, group, name) of any size,
    compared block by block, apart from groups within one component of ``labels`` (name, component)."""
    rows = written(rows.join(labels, "name", "left").select("dim", "group", "name", F.coalesce("component", "name").alias("component")), "crowded")
    groups = rows.groupBy("dim", "group").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    groups = groups.filter("lo != hi").select("dim", "group", F.ceil(F.col("n") / BLOCK).alias("subs"))
    up_to = F.explode(F.sequence(F.lit(0).cast("long"), F.col("subs") - 1)).alias("other")
    placed = rows.join(groups, ["dim", "group"]).withColumn("sub", F.pmod(F.xxhash64("name"), F.col("subs")))
    # each block meets each other one and itself
    met = placed.select("dim", "group", "name", "sub", up_to)
    pair = F.xxhash64("dim", "group", F.least("sub", "other"), F.greatest("sub", "other"))
    met = met.select("name", "dim", "group", (F.col("sub") <= F.col("other")).alias("left"), (F.col("sub") == F.col("other")).alias("alone"), pair.alias("pair"))
    met = met.join(vectors.select("name", "v"), "name")
    tasks = max(1, rows.count() // BLOCK)

    def compare(t: pa.Table) -> pa.Table:
        t = t.combine_chunks().sort_by("pair")
        pairs, names = t.column("pair").to_numpy(), t.column("name").to_numpy()
        left, alone = (t.column(c).to_numpy(zero_copy_only=False) for c in ("left", "alone"))
        cuts = np.flatnonzero(pairs[1:] != pairs[:-1]) + 1
        a, b = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(t)]):
            x = unit(matrix(t.column("v").slice(lo, hi - lo)))
            hit = x @ x.T >= cosine
            np.fill_diagonal(hit, False)
            if not alone[lo]:
                hit &= left[lo:hi, None] != left[None, lo:hi]
            i, j = _united(hit)
            a.append(names[lo:hi][i])
            b.append(names[lo:hi][j])
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    task = F.pmod(F.col("pair"), F.lit(tasks)).alias("task")
    return met.select(task, "pair", "name", "left", "alone", "v").groupBy("task").applyInArrow(compare, "a long, b long").distinct()


def _blocks(members: DataFrame) -> DataFrame:
    """Members with the block of their component that holds them: (ring, sub); one block for a
    component of at most BLOCK vectors."""
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("m"))
    big = sizes.filter(F.col("m") > BLOCK).select("component")
    pivot = members.join(big, "component").filter("name = component").select("component", F.col("v").alias("pivot"))

    def rings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            dims = b.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                r = b.filter(pa.array(dims == dim))
                cos = (unit(matrix(r.column("v"))) * unit(matrix(r.column("pivot")))).sum(axis=1)
                ring = np.minimum(np.arccos(np.clip(cos, -1, 1)) / math.pi * RINGS, RINGS - 1).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*(r.column(x) for x in ("component", "name", "dim", "v", "copies")), pa.array(ring)], ["component", "name", "dim", "v", "copies", "ring"])

    kind = f"component long, name long, dim int, v {dict(members.dtypes)['v']}, copies long, ring int"
    columns = ["component", "name", "dim", "v", "copies"]
    ringed = members.join(pivot, "component").select(*columns, "pivot").mapInArrow(rings, kind)
    subs = ringed.groupBy("component", "ring").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("subs"))
    large = ringed.join(subs, ["component", "ring"]).select(*columns, "ring", F.pmod(F.xxhash64("name"), F.col("subs")).cast("int").alias("sub"))
    small = members.join(big, "component", "left_anti").select(*columns, F.lit(-1).alias("ring"), F.lit(0).alias("sub"))
    return small.union(large)


def link_counts(members: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(name, n): for every member (component, name, dim, v, copies) the rows it links with, its own copies included."""
    blocks = written(_blocks(members), "blocks")
    theta, width = math.acos(cosine), math.pi / RINGS
    block = blocks.groupBy("component", "ring", "sub").agg(F.sum("copies").alias("copies"))
    other = block.select("component", F.col("ring").alias("ring2"), F.col("sub").alias("sub2"), F.col("copies").alias("copies2"))
    far = (F.abs(F.col("ring") - F.col("ring2")) - 1) * width > theta + 1e-9
    met = block.join(other, "component").filter(~far)
    sure = (F.col("ring") >= 0) & ((F.col("ring") + F.col("ring2") + 2) * width < theta - 1e-9)
    # rings so near their middle that all their members link
    near = met.filter(sure).groupBy("component", "ring", "sub").agg(F.sum("copies2").alias("n"))
    certain = blocks.join(near, ["component", "ring", "sub"]).select("name", "n")
    rest = met.filter(~sure & F.struct("ring", "sub").__le__(F.struct("ring2", "sub2"))).select("component", "ring", "sub", "ring2", "sub2")
    pair = F.xxhash64("component", "ring", "sub", "ring2", "sub2").alias("pair")
    left = rest.select("component", "ring", "sub", pair, F.lit(0).alias("side"))
    right = rest.filter("ring != ring2 or sub != sub2").select("component", F.col("ring2").alias("ring"), F.col("sub2").alias("sub"), pair, F.lit(1).alias("side"))
    rows = blocks.join(left.union(right), ["component", "ring", "sub"])
    # small components share a task
    tasks = max(1, blocks.count() // BLOCK)

    def count(t: pa.Table) -> pa.Table:
        t = t.combine_chunks().sort_by("pair")
        pairs, side = t.column("pair").to_numpy(), t.column("side").to_numpy()
        names, copies = t.column("name").to_numpy(), t.column("copies").to_numpy()
        cuts = np.flatnonzero(pairs[1:] != pairs[:-1]) + 1
        n = np.zeros(len(t), dtype=np.int64)
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(t)]):
            x = unit(matrix(t.column("v").slice(lo, hi - lo)))
            i, j = np.flatnonzero(side[lo:hi] == 0), np.flatnonzero(side[lo:hi] == 1)
            if not len(j):
                for a in range(0, len(i), 500):
                    n[lo + a:lo + min(a + 500, len(i))] = (x[a:a + 500] @ x.T >= cosine) @ copies[lo:hi]
                continue
            for a in range(0, len(i), 500):
                hit = x[i[a:a + 500]] @ x[j].T >= cosine
                n[lo + i[a:a + 500]] += hit @ copies[lo + j]
                n[lo + j] += copies[lo + i[a:a + 500]] @ hit
        return pa.table({"name": names, "n": n})

    task = F.pmod(F.col("pair"), F.lit(tasks)).alias("task")
    compared = rows.select(task, "pair", "side", "name", "copies", "v").groupBy("task").applyInArrow(count, "name long, n long")
    return certain.union(compared).groupBy("name").agg(F.sum("n").alias("n"))


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept): every row of ``vectors`` (vec_id, embedding).

    A vector that is null, empty, zero or holds null or non-finite components links with
    nothing; vectors of different length do not link. Equal vectors link, so repeated rows do.
    A null vec_id takes part but is the smallest only where there is no other. An empty table
    gives an empty result. Other columns are ignored.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
    rows = rows.withColumn("name", F.when(usable(F.col("v")), F.xxhash64("v")))
    good = rows.filter("name is not null")
    distinct = written(good.groupBy("name").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.any_value("v").alias("v")).withColumn("dim", F.size("v")), "vectors")
    n = distinct.count()
    passes, bits = passes_for(n, cosine), prefix_bits(n)
    crowded = crowded_groups(distinct, passes, bits)
    links = written(window_links(pass_names(distinct, passes, bits, crowded), bits, cosine), "window-links")
    labels = written(components(links), "components").select(F.col("id").alias("name"), "component")
    if crowded.any():
        in_crowds = pass_names(distinct, passes, bits, crowded, wide=False)
        more = written(crowded_links(distinct, in_crowds, labels, cosine), "crowded-links")
        if not more.isEmpty():
            united = labels.select(F.col("name").alias("a"), F.col("component").alias("b")).filter("a != b").union(more)
            labels = written(components(united), "components").select(F.col("id").alias("name"), "component")
    members = distinct.join(labels, "name").select("component", "name", "dim", "v", "copies", "least")
    members = written(members, "component-members")
    least = members.groupBy("component").agg(F.min("least").alias("component_id"))
    counts = link_counts(members.drop("least"), cosine)
    of = members.select("component", "name").join(least, "component").join(counts, "name").select("name", "component_id", "n")
    classes = distinct.select("name", "least", "copies").join(of, "name", "left").select("name", F.coalesce("n", "copies").alias("n"), F.when(F.col("n").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"))
    linked = good.select("vec_id", "name").join(classes, "name").select("vec_id", (F.col("n") - 1).alias("n_links"), "component_id")
    alone = rows.filter("name is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
