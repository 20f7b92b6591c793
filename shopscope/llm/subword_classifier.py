"""Quality classifier on averaged subword embeddings.

A document is the average of learned vectors: of its words, its pairs of
neighbouring words and the character n-grams of its words, all hashed to
``BUCKETS`` rows. A pair of equal words is one feature whatever the word. A
softmax layer on the average gives the label; numpy stochastic gradient descent
trains vectors and layer together, in one task, on a bounded sample of labelled
documents (``TRAIN_DOCS``, ``TRAIN_BYTES``: the first by hash). Because layer
and average are linear, a trained feature reduces to one number, so scoring is
one pass over whole texts without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopscope.llm.shared import small_batches, unused
from shopscope.llm.words import U, mix, text_batches, words_of

BUCKETS = 1 << 16
DIM = 16
GRAMS = (3, 4, 5)
#: Bounds of the training sample: labelled documents, and bytes of their features.
TRAIN_DOCS = 6000
TRAIN_BYTES = 150_000_000
EPOCHS = 4
RATE = 0.5
THRESHOLD = 0.7
SEED = 7


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashed features of a batch: (bucket of every feature of a distinct word, first of each
    distinct word, distinct word of each place, bucket of the pair that starts at each place,
    bounds of the texts). The last place of a text has no pair: bucket -1."""
    words, bounds = words_of(texts)
    distinct = words.dictionary
    which = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    names = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct.to_pylist()), dtype=U, count=len(distinct))
    lt, gt, none = (pa.scalar(x, distinct.type) for x in ("<", ">", ""))
    marked = pc.binary_join_element_wise(lt, distinct, gt, none).cast(pa.large_binary())
    ends = np.frombuffer(marked.buffers()[1], dtype=np.int64)[marked.offset:marked.offset + len(marked) + 1] if len(marked) else np.zeros(1, dtype=np.int64)
    raw = np.frombuffer(marked.buffers()[2], dtype=np.uint8)[ends[0]:ends[-1]].astype(U) if len(marked) else np.zeros(0, dtype=U)
    ends = ends - ends[0]
    word = np.repeat(np.arange(len(distinct)), np.diff(ends))
    owners, buckets = [np.arange(len(distinct))], [mix(names) % U(BUCKETS)]
    for n in GRAMS:
        if len(raw) < n:
            continue
        h = np.full(len(raw) - n + 1, n, dtype=U)
        for j in range(n):
            h = h * U(1099511628211) + raw[j:len(raw) - n + 1 + j]
        inside = word[:len(h)] == word[n - 1:]
        owners.append(word[:len(h)][inside])
        buckets.append(mix(h[inside]) % U(BUCKETS))
    owner, bucket = np.concatenate(owners), np.concatenate(buckets).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    first = np.searchsorted(owner[order], np.arange(len(distinct) + 1))
    pair = np.full(len(which), -1, dtype=np.int64)
    if len(which) > 1:
        a, b = names[which[:-1]], names[which[1:]]
        pair[:-1] = np.where(a == b, U(1), mix(a * U(3) + b) % U(BUCKETS)).astype(np.int64)
        last = bounds[1:][(bounds[1:] > bounds[:-1])] - 1
        pair[last] = -1
    return bucket[order], first, which, pair, bounds


def training_rows(docs: DataFrame) -> DataFrame:
    """(label, key, ids, weights): each text's distinct buckets and their shares, as bytes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches):
            bucket, first, which, pair, bounds = features(b.column("text"))
            size = np.diff(first)
            ids, shares = [], []
            for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                w = which[lo:hi]
                n = size[w]
                at = np.repeat(first[:-1][w] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                p = pair[lo:hi]
                found, count = np.unique(np.concatenate([bucket[at], p[p >= 0]]), return_counts=True)
                ids.append(found.astype(np.int32).tobytes())
                shares.append((count / max(1, count.sum())).astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("label"), b.column("key"), pa.array(ids, pa.binary()), pa.array(shares, pa.binary())], ["label", "key", "ids", "weights"])

    return docs.select("label", "key", "text").mapInArrow(rows, "label int, key long, ids binary, weights binary")


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = EPOCHS, rate: float = RATE) -> np.ndarray:
    """Log-odds of label 1 per bucket and, at the end, of an empty text, after stochastic gradient descent."""
    rng = np.random.default_rng(SEED)
    v = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM)).astype(np.float32)
    w = np.zeros((DIM, 2), dtype=np.float32)
    bias = np.zeros(2, dtype=np.float32)
    steps, step = max(1, epochs * len(rows)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(rows)).tolist():
            label, ids, share = rows[i]
            lr = np.float32(rate * (1 - step / steps))
            step += 1
            h = share @ v[ids]
            z = h @ w + bias
            e = np.exp(z - z.max())
            g = e / e.sum()
            g[label] -= 1
            # the average makes single features' steps small: their rows move by their share of the text
            v[ids] -= lr * len(ids) ** 0.5 * np.outer(share, w @ g).astype(np.float32)
            w -= lr * np.outer(h, g).astype(np.float32)
            bias -= lr * np.float32(0.1) * g
    return np.append(v @ (w[:, 1] - w[:, 0]), bias[1] - bias[0]).astype(np.float64)


def trained(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """The model (see ``fit``) from labelled rows (doc_id, label) and their texts."""
    small_batches(docs.sparkSession)
    key = F.xxhash64("doc_id", F.lit(SEED))
    sample = labels.filter("doc_id is not null and label is not null").groupBy("doc_id").agg(F.min("label").cast("int").alias("label"))
    sample = sample.withColumn("key", key).orderBy("key", "doc_id").limit(TRAIN_DOCS)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = training_rows(docs.join(sample, "doc_id").select("label", "key", "text"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, room = [], TRAIN_BYTES
        for b in batches:
            for label, ids, share in zip(*(b.column(c).to_pylist() for c in ("label", "ids", "weights"))):
                room -= len(ids) + len(share)
                if room >= 0:
                    held.append((label, np.frombuffer(ids, dtype=np.int32), np.frombuffer(share, dtype=np.float32)))
        yield pa.RecordBatch.from_arrays([pa.array([fit(held).tobytes()], pa.binary())], ["model"])

    model = rows.repartition(1).sortWithinPartitions("key", "ids").mapInArrow(learn, "model binary").collect()
    return np.frombuffer(model[0]["model"], dtype=np.float64) if model else np.zeros(BUCKETS + 1)


def scores(docs: DataFrame, model: np.ndarray, *keep: str) -> DataFrame:
    """The columns ``keep`` and, as the last one (``quality_score`` unless kept columns have that
    name), the probability of label 1 for every whole text."""
    column = unused(docs, "quality_score")
    odds, empty = model[:-1], float(model[-1])
    kinds = dict(docs.dtypes)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches):
            bucket, first, which, pair, bounds = features(b.column("text"))
            total = np.concatenate(([0.0], np.cumsum(odds[bucket])))
            word, size = total[first[1:]] - total[first[:-1]], np.diff(first)
            at = word[which] + np.where(pair >= 0, odds[pair], 0)
            n = size[which] + (pair >= 0)
            doc = np.repeat(np.arange(len(b)), np.diff(bounds))
            sums = np.bincount(doc, weights=at, minlength=len(b))
            counts = np.bincount(doc, weights=n, minlength=len(b))
            p = 1 / (1 + np.exp(-np.clip(sums / np.maximum(counts, 1) + empty, -30, 30)))
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in keep), pa.array(p)], [*keep, column])

    columns = list(dict.fromkeys([*keep, "text"]))
    return docs.select(*columns).mapInArrow(score, "".join(f"`{k}` {kinds[k]}, " for k in keep) + f"{column} double")


def held_out(doc_id: Column) -> Column:
    """Whether a row's label is kept from training; null ids have no label."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled(labels: DataFrame) -> DataFrame:
    """(doc_id, label) of the labels that training may see."""
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("label"))
    return marked.filter(~held_out(F.col("doc_id")))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``; ``labels``: (doc_id, quality).

    Null and empty texts get the score of a text without features. A null doc_id has no label and
    is not held out. Documents labelled twice train with the smaller label; without any labelled
    row every score is 0.5. Repeated rows get equal scores. An empty table gives an empty result.
    Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = trained(docs, labelled(labels))
    scored = scores(docs, model, "doc_id").withColumnRenamed("quality_score", "score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
