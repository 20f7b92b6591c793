"""Nearest neighbours by inner product over balanced posting lists.

* Vectors of equal dimension are compared, each dimension by itself. Vectors are
  scaled and get one more component that makes all of them equally long, so the
  largest inner product is the smallest distance (queries, scaled to length 1,
  get a zero there). Few vectors that are much longer than the others would
  flatten them: they form a range of lengths with an index of its own, and so
  on (``ranges``); queries search all ranges.
* A bounded sample gives the centroids: k-means whose assignment charges full
  clusters, so lists stay balanced; dense regions get centroids in proportion.
* Every vector is indexed: in its nearest centroid's list and, if it lies near
  a boundary, also in the next ones (``REPLICAS`` at most, distance ratio
  ``REPLICA_RATIO``).
* The centroids, at most ``MAX_LISTS``, form an in-memory neighbour graph, all
  of them within reach of each other. A best-first walk of the graph finds a
  query's nearest centroids; lists whose centroid is farther than
  ``SEARCH_RATIO`` times the nearest are pruned.
* Every run measures how many lists its queries need: a bounded sample of them is
  answered by brute force, and the searched lists and the walk's width grow until
  ``RECALL`` of these answers is found, if need be to all lists.
* Lists and their queries meet in tasks of bounded size: a long list or one
  with many queries is split into a grid. Scores are computed in double
  precision on the original vectors.

Equal vectors are indexed once, with their smallest ids: no result can hold
more of them than it has ranks, as ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopscope.llm.shared import written
from shopscope.llm.vectors import matrix, unit, usable

K = 20
#: Vectors per list, aimed at; lists at most; bytes of the sample that centroids are fitted on.
LIST_SIZE = 128
MAX_LISTS = 16384
SAMPLE_BYTES = 16_000_000
REPLICAS = 4
REPLICA_RATIO = 1.3
#: Lists searched: at most, unless the run's calibration needs more, and at least, and the distance
#: ratio that prunes between.
SEARCH_LISTS = 64
LEAST_LISTS = 24
SEARCH_RATIO = 1.6
#: Share of the brute-force answers that the calibration asks for, and its queries at most.
RECALL = 0.95
CALIBRATION = 256
#: Walk width, at least, and neighbours of the centroid graph.
BEAM = 96
DEGREE = 24
#: Rows of a list and of its queries that meet in one task.
LIST_ROWS = 4000
QUERY_ROWS = 8000
SEED = 4


def fit_centroids(sample: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """Centroids of a sample; a cluster's size is charged on the distance to it."""
    rng = np.random.default_rng(SEED)
    c = sample[rng.choice(len(sample), k, replace=False)].copy()
    share = len(sample) / k
    charge = np.zeros(k, dtype=sample.dtype)
    for _ in range(rounds):
        to = np.concatenate([((c * c).sum(1) + charge - 2 * sample[a:a + 4096] @ c.T).argmin(1) for a in range(0, len(sample), 4096)])
        size = np.bincount(to, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, to, sample)
        c = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], c)
        spread = ((sample - c[to]) ** 2).sum(1).mean()
        charge = (0.1 * spread * (size / share - 1)).astype(sample.dtype)
    return c


class CentroidGraph:
    """Neighbour graph of the centroids, walked best first for many queries at once."""

    def __init__(self, centroids: np.ndarray):
        self.c, self.half = centroids, (centroids * centroids).sum(1)
        self.beam = BEAM  # alike on driver and executors
        k, rng = len(centroids), np.random.default_rng(SEED)
        deg = min(DEGREE, k - 1)
        near = np.zeros((k, deg), dtype=np.int32)
        for a in range(0, k, 1024):
            d = self.half - 2 * centroids[a:a + 1024] @ centroids.T
            d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
            if deg:
                near[a:a + 1024] = np.argpartition(d, deg - 1, axis=1)[:, :deg]
        # a third of the edges lead to random centroids, so that the walk can cross the space
        far = max(0, deg // 3) if k > 3 * DEGREE else 0
        if far:
            near[:, deg - far:] = rng.integers(0, k, (k, far))
        if deg:  # a ring through all: a walk that is wide enough meets every centroid
            ring = rng.permutation(k)
            near[ring, 0] = np.roll(ring, -1)
        order = np.argsort(near, axis=1, kind="stable")
        ranked = np.take_along_axis(near, order, axis=1)
        self.twice = np.zeros(near.shape, dtype=bool)  # random and ring edges may repeat a near one
        np.put_along_axis(self.twice, order[:, 1:], ranked[:, 1:] == ranked[:, :-1], axis=1)
        self.near, self.entries = near, rng.choice(k, min(k, 32), replace=False)

    def search(self, q: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
        """(centroids, squared distances) of the m nearest found for each query, nearest first. The
        walk is half as wide again as m."""
        rows, k = np.arange(len(q))[:, None], len(self.c)
        own = (q * q).sum(1)[:, None]
        beam = max(self.beam, m + m // 2)
        seen = np.zeros((len(q), k), dtype=bool)
        ids = np.broadcast_to(self.entries, (len(q), len(self.entries))).copy()
        seen[rows, ids] = True
        d = own + self.half[ids] - 2 * q @ self.c[self.entries].T
        done = np.zeros(ids.shape, dtype=bool)
        while True:
            open_d = np.where(done, np.inf, d)
            at = open_d.argmin(1)
            if np.isinf(open_d[rows[:, 0], at]).all():
                break
            done[rows[:, 0], at] = True
            here = ids[rows[:, 0], at]
            nb = self.near[here]
            nd = own + self.half[nb] - 2 * np.einsum("bd,bnd->bn", q, self.c[nb])
            nd = np.where(seen[rows, nb] | self.twice[here] | np.isinf(open_d[rows[:, 0], at])[:, None], np.inf, nd)
            seen[rows, nb] = True
            ids, d = np.concatenate([ids, nb], axis=1), np.concatenate([d, nd], axis=1)
            done = np.concatenate([done, np.isinf(nd)], axis=1)
            if ids.shape[1] > beam:
                keep = np.argpartition(d, beam - 1, axis=1)[:, :beam]
                ids, d, done = ids[rows, keep], d[rows, keep], done[rows, keep]
        best = np.argsort(d, axis=1, kind="stable")[:, :m]
        return ids[rows, best], d[rows, best]


def _longer(x: np.ndarray, big: float, most: float) -> np.ndarray:
    """Vectors scaled into the unit ball by their range's largest component and length, with the
    component that puts them on the sphere."""
    x = x / big / most
    rest = np.sqrt(np.maximum(1 - (x * x).sum(1), 0))
    return np.concatenate([x, rest[:, None]], axis=1).astype(np.float32)


def _to_search(d: np.ndarray, ratio: float) -> np.ndarray:
    """Which of a query's lists, nearest first, are searched."""
    use = (d <= ratio ** 2 * np.maximum(d[:, :1], 0)) & np.isfinite(d)
    use[:, :LEAST_LISTS] = np.isfinite(d[:, :LEAST_LISTS])
    return use


def _asked(q: np.ndarray) -> np.ndarray:
    """Queries among the vectors of ``_longer``: what is nearest doesn't depend on a query's length."""
    return np.concatenate([unit(q), np.zeros((len(q), 1))], axis=1).astype(np.float32)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products in doubles; sums beyond their range are infinite, undefined ones come last."""
    with np.errstate(over="ignore", invalid="ignore"):
        s = q @ x.T
    return np.where(np.isnan(s), -np.inf, s)


def true_neighbours(index: DataFrame, names: np.ndarray, q: np.ndarray, k: int) -> DataFrame:
    """(query, name): by brute force the k best other vectors of the index for a bounded set of queries."""
    shared = index.sparkSession.sparkContext.broadcast((names, q))  # CALIBRATION queries at most

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, q = shared.value
        at, score = np.zeros((len(q), 0), dtype=np.int64), np.zeros((len(q), 0))
        for b in batches:
            for a in range(0, len(b), 4096):
                some = b.slice(a, 4096)
                name = some.column("name").to_numpy()
                s = np.where(name == names[:, None], -np.inf, products(q, matrix(some.column("v"))))
                at, score = np.concatenate([at, np.broadcast_to(name, s.shape)], axis=1), np.concatenate([score, s], axis=1)
                if score.shape[1] > k:
                    top = np.argpartition(-score, k - 1, axis=1)[:, :k]
                    at, score = np.take_along_axis(at, top, axis=1), np.take_along_axis(score, top, axis=1)
        found = score > -np.inf
        yield pa.RecordBatch.from_arrays([pa.array(np.broadcast_to(names[:, None], at.shape)[found]), pa.array(at[found]), pa.array(score[found])], ["query", "name", "score"])

    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "name"))
    each = index.select("name", "v").mapInArrow(best, "query long, name long, score double")
    return each.withColumn("place", place).filter(F.col("place") <= k).select("query", "name")


def calibrated(graph: CentroidGraph, names: np.ndarray, q: np.ndarray, held: pa.Table) -> tuple[int, float]:
    """(lists searched at most, distance ratio): the least number, doubled by steps, with which the
    walk reaches ``RECALL`` of the true neighbours ``held`` (query, name, list), else all lists."""
    k, m, ratio = len(graph.c), min(SEARCH_LISTS, len(graph.c)), SEARCH_RATIO
    if not len(held):
        return m, ratio
    row = np.searchsorted(names, held.column("query").to_numpy())
    lists = held.column("list").to_numpy()
    _, answer = np.unique(np.stack([row, held.column("name").to_numpy()]), axis=1, return_inverse=True)
    n = answer.max() + 1

    def recall() -> float:
        to, d = graph.search(_asked(q), m)
        hit = np.zeros((len(q), k), dtype=bool)
        at = np.broadcast_to(np.arange(len(q))[:, None], to.shape)
        hit[at, to] = _to_search(d, ratio)
        return len(np.unique(answer[hit[row, lists]])) / n

    while recall() < RECALL and (m < k or ratio < np.inf):
        if m < k:
            m = min(k, m + m // 4 + 1)
        if m == k and recall() < RECALL:
            ratio = np.inf  # the ratio itself prunes too much: search again from few lists, without it
            m = min(SEARCH_LISTS, k)
            while m < k and recall() < RECALL:
                m = min(k, m + m // 4 + 1)
            break
    return m, float(ratio)


def _found(index: DataFrame, queries: DataFrame, dim: int, k: int) -> DataFrame:
    """(query, name, score): what the lists of one range hold for the queries, the k + 1 best of each task."""
    spark = index.sparkSession
    n, big = index.agg(F.count(F.lit(1)), F.max(F.array_max(F.transform("v", F.abs)))).first()
    most = index.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + (x / big) * (x / big))))).first()[0]

    sample = index.select("v").orderBy(F.xxhash64("name", F.lit(SEED))).limit(max(1, SAMPLE_BYTES // (8 * dim))).toArrow()
    sample = _longer(matrix(sample.column("v")), big, most)
    graph = CentroidGraph(fit_centroids(sample, int(np.clip(n // LIST_SIZE, 1, min(MAX_LISTS, len(sample))))))
    shared = spark.sparkContext.broadcast(graph)  # MAX_LISTS centroids at most

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, half = shared.value.c, shared.value.half
        r = min(REPLICAS, len(c))
        for b in batches:
            for a in range(0, len(b), 1024):
                some = b.slice(a, 1024)
                x = _longer(matrix(some.column("v")), big, most)
                d = (x * x).sum(1)[:, None] + half - 2 * x @ c.T
                to = np.argpartition(d, r - 1, axis=1)[:, :r]
                d = np.take_along_axis(d, to, axis=1)
                use = d <= REPLICA_RATIO ** 2 * np.maximum(d.min(axis=1, keepdims=True), 0) + 1e-9
                at = np.nonzero(use)[0]
                yield pa.RecordBatch.from_arrays([pa.array(to[use].astype(np.int32)), *(some.column(i).take(pa.array(at)) for i in ("name", "v", "ids"))], ["list", "name", "v", "ids"])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a in range(0, len(b), 256):
                some = b.slice(a, 256)
                to, d = shared.value.search(_asked(matrix(some.column("v"))), most_lists)
                use = _to_search(d, ratio)
                yield pa.RecordBatch.from_arrays([pa.array(to[use].astype(np.int32)), some.column("name").take(pa.array(np.nonzero(use)[0]))], ["list", "query"])

    lists = written(index.mapInArrow(assign, "list int, name long, v array<double>, ids array<long>"), "posting-lists")
    some = queries.orderBy(F.xxhash64("name", F.lit(SEED + 1))).limit(CALIBRATION).toArrow().sort_by("name")
    names, q = some.column("name").to_numpy(), matrix(some.column("v")).reshape(len(some), dim)
    true = true_neighbours(index, names, q, k)
    most_lists, ratio = calibrated(graph, names, q, lists.select("name", "list").join(F.broadcast(true), "name").select("query", "name", "list").toArrow())
    routed = written(queries.mapInArrow(route, "list int, query long"), "routed-queries")

    # the grid of each list, at most MAX_LISTS rows
    parts = lists.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / LIST_ROWS).alias("ip"))
    splits = routed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / QUERY_ROWS).alias("qp"))
    grid = parts.join(splits, "list")
    up_to = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = lists.join(grid, "list").withColumn("i", F.pmod(F.xxhash64("name"), F.col("ip"))).withColumn("j", up_to("qp")).select("list", "i", "j", "name", "v", "ids")
    right = routed.join(grid, "list").withColumn("j", F.pmod(F.xxhash64("query"), F.col("qp"))).withColumn("i", up_to("ip")).select("list", "i", "j", "query")
    right = right.join(queries.select(F.col("name").alias("query"), F.col("v").alias("q")), "query").select("list", "i", "j", "query", "q")

    def scan(items: pa.Table, asks: pa.Table) -> pa.Table:
        names = items.column("name").to_numpy()
        x, qs, q_names = matrix(items.column("v")), matrix(asks.column("q")), asks.column("query").to_numpy()
        out_q, out_i, out_s = [], [], []
        if len(x) and len(qs):
            top = min(2 * k + 2, len(x))
            for a in range(0, len(qs), 512):
                q = qs[a:a + 512]
                s = products(q, x)
                best = np.argpartition(-s, top - 1, axis=1)[:, :top]
                # the same sum for a pair in whatever task it is computed
                with np.errstate(over="ignore", invalid="ignore"):
                    s = (q[:, None, :] * x[best]).sum(axis=2)
                s = np.where(np.isnan(s), -np.inf, s)
                rank = np.argsort(-s, axis=1, kind="stable")[:, :k + 1]
                out_q.append(np.repeat(q_names[a:a + 512], rank.shape[1]))
                out_i.append(np.take_along_axis(best, rank, axis=1).ravel())
                out_s.append(np.take_along_axis(s, rank, axis=1).ravel())
        flat = lambda xs, kind: np.concatenate(xs) if xs else np.zeros(0, dtype=kind)
        i = flat(out_i, np.int64)
        return pa.table({"query": flat(out_q, np.int64), "name": names[i] if len(i) else i, "score": flat(out_s, np.float64)})

    return left.groupBy("list", "i", "j").cogroup(right.groupBy("list", "i", "j")).applyInArrow(scan, "query long, name long, score double")


def ranges(index: DataFrame) -> list[DataFrame]:
    """The vectors by length, so that none is much longer than most others of its range: all up to four
    times the length that 0.999 of them have, then the same of the rest. Each range takes in nearly all
    that is left, so there are a few at most."""
    index = index.withColumn("size", F.array_max(F.transform("v", F.abs)))
    out, above = [], 0.0
    while True:
        rest = index.filter(F.col("size") > above)
        usual, most = rest.agg(F.percentile_approx("size", 0.999, 10_000), F.max("size")).first()
        if most is None:
            return out
        limit = most if most / 4 <= usual else 4 * usual
        out.append(rest.filter(F.col("size") <= limit).drop("size"))
        above = limit


def nearest(vectors: DataFrame, is_query, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for every row that ``is_query`` holds for.

    ``vectors``: (vec_id, embedding). A vector that is null, empty, zero or holds null or
    non-finite components takes no part; candidates of a query are the vectors of its own dimension.
    A query's own row is left out, an equal row is not. Ties go to the smaller vec_id, null ids
    last. With fewer candidates than k all are returned; an empty table gives an empty result. An
    inner product beyond the range of doubles is infinite, an undefined one the last.
    Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.filter(usable(F.col("v")))
    dims = [r[0] for r in rows.select(F.size("v")).distinct().collect()]  # a table has few dimensions
    out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for i, dim in enumerate(sorted(dims)):
        found = _nearest_of_dimension(rows.filter(F.size("v") == dim), dim, is_query, k)
        out = found if not i else out.unionAll(found)
    return out


def _nearest_of_dimension(rows: DataFrame, dim: int, is_query, k: int) -> DataFrame:
    rows = rows.withColumn("name", F.xxhash64("v"))

    first = Window.partitionBy("name").orderBy(F.col("vec_id").asc_nulls_last())
    ids = rows.select("name", "vec_id").withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= k + 1)
    ids = ids.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("nth", "vec_id"))).alias("ids")).select("name", F.col("ids.vec_id").alias("ids"))
    distinct = rows.groupBy("name").agg(F.any_value("v").alias("v"))
    index = written(distinct.join(ids, "name"), "distinct-vectors")
    asked = rows.filter(is_query(F.col("vec_id"))).select("vec_id", "name")
    queries = written(index.join(asked.select("name").distinct(), "name").select("name", "v"), "query-vectors")
    found = None
    for part in ranges(index):
        of_range = _found(part, queries, dim, k)
        found = of_range if found is None else found.unionAll(of_range)
    by_name = Window.partitionBy("query").orderBy(F.desc("score"), "least", "name")
    best = found.groupBy("query", "name").agg(F.max("score").alias("score"))
    # ids only of what can still be a result: the k + 1 best texts by score, ties included
    cut = best.withColumn("place", F.rank().over(Window.partitionBy("query").orderBy(F.desc("score")))).filter(F.col("place") <= k + 1)
    held = cut.join(index.select("name", "ids"), "name").withColumn("least", F.element_at("ids", 1))
    held = held.withColumn("nth", F.row_number().over(by_name)).filter(F.col("nth") <= k + 1)
    each = held.select("query", "name", "score", F.posexplode("ids").alias("copy", "vec_id"))
    by_row = Window.partitionBy("query").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "name", "copy")
    top = each.withColumn("nth", F.row_number().over(by_row)).filter(F.col("nth") <= k + 1)
    answers = top.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("nth", "vec_id", "score", "name"))).alias("found"))

    # each query row: without its own row, k at most
    one = asked.withColumnRenamed("name", "query").join(answers, "query")
    own = F.filter("found", lambda x: (x["name"] == F.col("query")) & (x["vec_id"] == F.col("vec_id")))
    own = F.coalesce(F.get(own, F.lit(0))["nth"], F.lit(0))
    rest = F.slice(F.filter("found", lambda x: x["nth"] != F.col("own")), 1, k)
    out = one.withColumn("own", own).select(F.col("vec_id").alias("query_id"), F.posexplode(rest).alias("at", "r"))
    return out.select("query_id", (F.col("at") + 1).alias("rank"), F.col("r.vec_id").alias("vec_id"), F.col("r.score").alias("score"))
