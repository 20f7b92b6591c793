"""Target-distribution importance resampling by hashed word n-grams.

Features of a text are its runs of one to three words. Their buckets are
counted over the whole corpus and over the whole target; a bucket's gain is the
logarithm of how much more frequent it is in the target, and a document's
weight is the sum of its features' gains. Gumbel noise on the weights turns the
draw of k documents without replacement into a choice of the k highest scores.

The cutoff is found without sorting the corpus: a quantile sketch of the scores
proposes a bracket around rank k, exact counts above and inside it accept the
bracket or widen it, and only rows of the bracket are ordered. Rows above it are
drawn, and rows below it are not.

A feature's bucket is the crc32 of its text. The crc32 of joined strings follows
from those of its parts (appending bytes is linear over bits), so a batch calls
zlib once per distinct word and numpy does the rest.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopscope.llm.shared import written
from shopscope.llm.words import alnum_texts, text_batches, words_of
from shopscope.plans.ordering import global_order

BUCKETS = 10_000
LONGEST_RUN = 3
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
#: Text bytes of a batch: a word takes some hundred bytes in the steps below.
BATCH_BYTES = 2_000_000
#: Rank error of the first bracket, as a share of the rows; each failed bracket is four times as wide.
MARGIN = 0.001
#: The sketch's rank error is one over this.
ACCURACY = 20_000

# Fixed value: the polynomial of crc32, lowest bit first.
POLYNOMIAL = 0xEDB88320


def _applied(table: np.ndarray, x: np.ndarray) -> np.ndarray:
    """A linear map of 32-bit values, given as its values on each byte."""
    out = table[0][x & 255]
    for byte in (1, 2, 3):
        out = out ^ table[byte][(x >> np.uint32(8 * byte)) & 255]
    return out


@functools.cache
def _appending(power: int) -> np.ndarray:
    """What ``2**power`` zero bytes at the end do to a crc32, as 4 x 256 values."""
    each = np.arange(256, dtype=np.uint32)
    places = np.stack([each << np.uint32(8 * byte) for byte in range(4)])
    if power:
        half = _appending(power - 1)
        return _applied(half, _applied(half, places))
    one = each.copy()
    for _ in range(8):
        one = np.where(one & 1, (one >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), one >> np.uint32(1))
    return one[places & 255] ^ (places >> np.uint32(8))


def joined_crc(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """crc32 of each pair of strings put together; ``length``: bytes of the second."""
    out = first.copy()
    for power in range(int(length.max()).bit_length() if len(length) else 0):
        at = np.flatnonzero(length >> power & 1)
        out[at] = _applied(_appending(power), out[at])
    return out ^ second


def features(texts: pa.Array) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """([(text of each feature, its bucket) for runs of 1, 2, 3 words], number of words of each text)."""
    words, bounds = words_of(alnum_texts(texts))
    distinct = words.dictionary.cast(pa.large_binary()).to_pylist()
    which = words.indices.to_numpy(zero_copy_only=False)
    word = np.fromiter(map(zlib.crc32, distinct), dtype=np.uint32, count=len(distinct))[which]
    length = np.fromiter(map(len, distinct), dtype=np.int64, count=len(distinct))[which]
    counts = np.diff(bounds)
    of = np.repeat(np.arange(len(texts)), counts)
    space = np.uint32(zlib.crc32(b" "))
    out, run = [], word
    for k in range(1, LONGEST_RUN + 1):
        if k > 1:
            # run + " " + next word, where both ends are in one text
            spaced = _applied(_appending(0), run[:-1]) ^ space
            run = joined_crc(spaced, word[k - 1:], length[k - 1:])
        inside = of[:len(run)] == of[k - 1:] if len(run) else np.zeros(0, dtype=bool)
        out.append((of[:len(run)][inside], (run[inside] % np.uint32(BUCKETS)).astype(np.int64)))
        if len(run) < 2:
            break
    return out, counts


def bucket_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """How many features of all texts fall into each bucket. Each task sends its sums, once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for b in text_batches(batches, limit=BATCH_BYTES):
            for _, bucket in features(b.column("text"))[0]:
                total += np.bincount(bucket, minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.record_batch({"bucket": pa.array(at), "n": pa.array(total[at])})

    rows = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "bucket long, n long")
    found = rows.groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()  # BUCKETS rows at most
    out = np.zeros(BUCKETS, dtype=np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the smoothed log ratio of each bucket's frequency, rounded down."""
    S, T = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    ratios = (target + 1.0) * S / ((corpus + 1.0) * T)
    return np.array([math.floor(1000 * math.log(r)) for r in ratios.tolist()], dtype=np.int64)


def scores(docs: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every document; the noise of a document depends
    on the seed and its id only (null: as an empty text)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))), 256)
    draw = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), draw.alias("draw"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_batches(batches, limit=BATCH_BYTES):
            found, n_words = features(b.column("text"))
            weight, n = np.zeros(b.num_rows, dtype=np.int64), np.zeros(b.num_rows, dtype=np.int64)
            for of, bucket in found:
                n += np.bincount(of, minlength=b.num_rows)
                # sums of integers far below 2**53 are exact in doubles
                weight += np.bincount(of, weights=gain[bucket], minlength=b.num_rows).astype(np.int64)
            noise = [math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))) for h in b.column("draw").to_pylist()]
            yield pa.record_batch({
                "doc_id": b.column("doc_id"), "n_words": pa.array(n_words), "n_features": pa.array(n),
                "weight": pa.array(weight), "score": pa.array(weight + np.array(noise, dtype=np.int64))})

    return rows.mapInArrow(score, "doc_id long, n_words long, n_features long, weight long, score long")


def bracket(rows: DataFrame, n: int, k: int, margin: float = MARGIN, accuracy: int = ACCURACY) -> tuple[int, int, int]:
    """(low, high, rows above high): the k-th highest of n scores lies in low..high. The sketch only
    proposes; exact counts decide, and a bracket that misses rank k is widened."""
    while True:
        at_low, at_high = 1 - k / n - margin, 1 - k / n + margin
        sketch = lambda q: F.percentile_approx("score", F.lit(q), F.lit(accuracy))
        low = F.min("score") if at_low <= 0 else sketch(at_low)
        high = F.max("score") if at_high >= 1 else sketch(at_high)
        low, high = rows.agg(low.alias("low"), high.alias("high")).first()
        above, inside = rows.agg(F.count_if(F.col("score") > high), F.count_if(F.col("score").between(low, high))).first()
        if above < k <= above + inside:
            return low, high, above
        margin *= 4


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of ``docs``; rank 1, 2, ... for the drawn
    ones, by falling score and rising doc_id (a null id first), null for the others.

    ``percent`` of the documents with at least ``least_words`` words are drawn, rounded down. Null and
    empty texts have no features, weight 0, and are not drawn. Repeated rows are separate documents; of
    rows equal in score and id any may come first. An empty target leaves gains of the corpus alone; an
    empty corpus gives an empty result. Other columns are not looked at.
    """
    gain = gains(bucket_counts(docs), bucket_counts(target))
    rows = written(scores(docs, gain, seed).withColumn("tie", F.monotonically_increasing_id()), "scores")
    fields = ["doc_id", "n_features", "weight", "score"]
    may = F.col("n_words") >= least_words
    n = rows.filter(may).count()
    k = n * percent // 100
    undrawn = F.lit(None).cast("long").alias("rank")
    if not k:
        return rows.select(*fields, undrawn)
    low, high, above = bracket(rows.filter(may), n, k)
    order = [("score", False), ("doc_id", True), ("tie", True)]
    surely = global_order(rows.filter(may & (F.col("score") > high)), order).select(*fields, F.col("_rn").alias("rank"))
    inside = global_order(rows.filter(may & F.col("score").between(low, high)), order)
    inside = inside.select(*fields, F.when(F.col("_rn") <= k - above, F.col("_rn") + above).alias("rank"))
    return surely.unionAll(inside).unionAll(rows.filter(~may | (F.col("score") < low)).select(*fields, undrawn))
