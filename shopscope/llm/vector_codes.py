"""Vector code compression: one codebook per part of the vectors, trained with norm-of-sum bounds.

Components become integers, vectors are cut into equal parts, and each part gets
the index of the nearest entry of its position's codebook. All distances are
exact: doubles where every intermediate value stays below 2**53, Python integers
beyond.

Between rounds a row keeps, for each part, an upper bound of the distance to its
entry and a lower bound of the distance to every other entry, both stamped with
the codebook round they were measured in. All earlier codebooks are retained
(they are a few thousand numbers), so a later round loosens a bound by how far
the entries have really moved since its stamp, the norm of the summed moves; the
sum of the norms of the single moves, which bounds usually drift by, is never
less. Only parts whose bounds then meet are measured again: first against their
own entry, and only if that doesn't settle it against all entries.

Rows stay where they are: a round is a map over the written rows and their
bounds, and sums per entry, one row per task and number, are all that is
shuffled. The rows of the round before are deleted when a round is written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopscope.llm.shared import importable, removed, stored

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Rows whose distances to all entries are held at a time.
STEP = 4096
#: Label rows are repeated, and rows dealt, this often when sums per label go back to the rows.
SALT = 16
#: Relative slack of a comparison of bounds: doubles are good to 1e-15.
SLACK = 1e-6
_MOST = (1 << 63) - 1


def finite(vector: Column) -> Column:
    """Neither null nor with a null or non-finite component (zero and empty vectors are)."""
    return F.coalesce(vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))


def integers(vectors: pa.Array, width: int) -> np.ndarray:
    """floor(256 x) of each component, rows filled up with 0 to ``width``: doubles below 2**53, else Python integers."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    ends, flat = vectors.offsets.to_numpy().astype(np.int64), vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    small = not len(flat) or np.abs(flat).max() < 2.0 ** 44
    scaled = np.floor(flat * SCALE) if small else np.array([int(x * SCALE // 1) if abs(x) < 2.0 ** 53 else int(x) * SCALE for x in flat.tolist()], dtype=object)
    sizes = np.diff(ends)
    if (sizes == width).all():
        return scaled.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), dtype=scaled.dtype)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], sizes)] = scaled
    return out


def _fits(*values: np.ndarray) -> bool:
    """Whether distances of such values (last axis) are exact in doubles."""
    most = max([int(abs(v).max()) for v in values if v.size], default=0)
    return 4 * most * most * max(values[0].shape[-1], 1) < 1 << 53


def _python(x: np.ndarray) -> np.ndarray:
    """The whole numbers as Python integers."""
    return np.frompyfunc(int, 1, 1)(x).astype(object)


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distance of each row to each entry, exact."""
    if x.dtype == object or entries.dtype == object:
        return ((_python(x)[:, None, :] - _python(entries)[None]) ** 2).sum(axis=-1)
    return (x * x).sum(axis=1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(axis=1)[None]


def moves(books: list[np.ndarray], part: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per earlier round: how far each entry of a part is now from where it was then, and the largest such move of all others."""
    out = []
    for then in books:
        move = np.sqrt(((books[-1][part] - then[part]) ** 2).sum(axis=1))
        order = np.argsort(move)
        others = np.full(len(move), move[order[-1]])
        others[order[-1]] = move[order[-2]] if len(move) > 1 else 0.0
        out.append((move, others))
    return out


class Bounds:
    """Codes and stamped bounds of a batch, one column per part."""

    NAMES = ("code", "upper", "lower", "upper_round", "lower_round")
    TYPES = (np.uint8, np.float32, np.float32, np.uint8, np.uint8)

    def __init__(self, rows: int, parts: int):
        self.code, self.upper, self.lower, self.upper_round, self.lower_round = (np.zeros((rows, parts), dtype=t) for t in self.TYPES)
        self.upper[:] = np.inf  # nothing known: everything is measured

    @classmethod
    def read(cls, batch: pa.RecordBatch, parts: int) -> Bounds:
        out = cls(0, parts)
        for name, kind in zip(cls.NAMES, cls.TYPES):
            raw = b"".join(batch.column(name).to_pylist())
            setattr(out, name, np.frombuffer(raw, dtype=kind).reshape(batch.num_rows, parts).copy())
        return out

    def columns(self) -> dict[str, pa.Array]:
        return {name: _binaries(getattr(self, name)) for name in self.NAMES}


def _binaries(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows)
    return pa.array([r.tobytes() for r in rows], pa.binary())


def assign(x: np.ndarray, bounds: Bounds, books: list[np.ndarray], exact: bool) -> tuple[np.ndarray | None, int]:
    """Bring codes and bounds to the newest codebook; (squared distances to the codes' entries if
    ``exact`` asks for them, number of parts compared with all entries). Equal distances go to the lower index."""
    now = len(books) - 1
    parts = books[-1].shape[0]
    d = books[-1].shape[2]
    plain = x.dtype != object and books[-1].dtype != object and _fits(x.reshape(len(x), parts, d), *books)
    if not plain:
        x, books = _python(x), [_python(b) for b in books]
    errors, scans = [], 0
    for p in range(parts):
        xp, book = x[:, p * d:(p + 1) * d], books[-1][p]
        code = bounds.code[:, p].astype(np.int64)
        todo = np.arange(len(x))
        if plain and now:
            moved = moves(books, p)
            own, others = np.stack([m[0] for m in moved]), np.stack([m[1] for m in moved])
            lower = bounds.lower[:, p].astype(np.float64) - others[bounds.lower_round[:, p], code]
            upper = bounds.upper[:, p].astype(np.float64) + own[bounds.upper_round[:, p], code]
            todo = np.flatnonzero(~(upper * (1 + SLACK) < lower * (1 - SLACK)))
            # measure the own entry anew before all others
            away = np.sqrt(((xp[todo] - book[code[todo]]) ** 2).sum(axis=1))
            bounds.upper[todo, p] = np.nextafter(away.astype(np.float32), np.float32(np.inf))
            bounds.upper_round[todo, p] = now
            todo = todo[~(away * (1 + SLACK) < lower[todo] * (1 - SLACK))]
        scans += len(todo)
        step = STEP if plain else 64
        for a in range(0, len(todo), step):
            rows = todo[a:a + step]
            to_all = distances(xp[rows], book)
            best = np.argmin(to_all, axis=1)  # the first of equal ones
            code[rows] = best
            if plain:
                least = to_all[np.arange(len(rows)), best]
                to_all[np.arange(len(rows)), best] = np.inf
                bounds.upper[rows, p] = np.nextafter(np.sqrt(least).astype(np.float32), np.float32(np.inf))
                bounds.lower[rows, p] = np.nextafter(np.minimum(np.sqrt(to_all.min(axis=1)), 1e30).astype(np.float32), np.float32(0))
                bounds.upper_round[rows, p] = bounds.lower_round[rows, p] = now
            else:
                bounds.upper[rows, p], bounds.lower[rows, p] = np.inf, 0
        bounds.code[:, p] = code
        if exact:
            errors.append(((xp - book[code]) ** 2).sum(axis=1))
    return (sum(errors) if exact else None), scans


def _sums(rows: DataFrame, parts: int, width: int, entries: int) -> dict[int, int]:
    """Sum of each component over the rows of each entry (cell: component x entries + entry) and the
    rows of each part and entry (cells from width x entries on)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + parts, entries), dtype=object)
        d = width // parts
        for b in batches:
            x = integers(b.column("embedding"), width)
            code = np.frombuffer(b"".join(b.column("code").to_pylist()), dtype=np.uint8).reshape(-1, parts)
            for p in range(parts):
                total[width + p] += np.bincount(code[:, p], minlength=entries)
                for c in range(p * d, (p + 1) * d):
                    if x.dtype == object or len(x) and np.abs(x[:, c]).max() * len(x) >= 2.0 ** 53:
                        np.add.at(total[c], code[:, p], x[:, c].astype(object) if x.dtype == object else np.array([int(v) for v in x[:, c]], dtype=object))
                    else:
                        total[c] += np.bincount(code[:, p], weights=x[:, c], minlength=entries).astype(np.int64)
        cell, limb, value = [], [], []
        for i, v in enumerate(int(v) for v in total.ravel()):
            k = 0
            while not -(1 << 31) <= v < 1 << 31:  # 32 bits at a time, so that sums of them stay in a BIGINT
                cell, limb, value = cell + [i], limb + [k], value + [v & 0xFFFFFFFF]
                v, k = v >> 32, k + 1
            if v:
                cell, limb, value = cell + [i], limb + [k], value + [v]
        yield pa.record_batch({"cell": pa.array(cell, pa.int64()), "limb": pa.array(limb, pa.int32()), "value": pa.array(value, pa.int64())})

    per = rows.select("embedding", "code").mapInArrow(add, "cell long, limb int, value long")
    out: dict[int, int] = {}
    for r in per.groupBy("cell", "limb").agg(F.sum("value").alias("value")).collect():  # (width + parts) x entries cells
        out[r.cell] = out.get(r.cell, 0) + (r.value << 32 * r.limb)
    return out


def _numbers(values: list) -> np.ndarray:
    """Integers as doubles where those are exact."""
    out = np.array(values, dtype=object)
    return out.astype(np.float64) if not out.size or max(abs(int(v)) for v in out.ravel()) < 1 << 52 else out


def updated(book: np.ndarray, sums: dict[int, int]) -> np.ndarray:
    """Each entry replaced by floor(sum / count) of its parts; unused entries stay."""
    parts, entries, d = book.shape
    width = parts * d
    out = book.astype(object)
    for p in range(parts):
        for e in range(entries):
            n = sums.get((width + p) * entries + e, 0)
            if n:
                out[p, e] = [sums.get((p * d + i) * entries + e, 0) // n for i in range(d)]
    return _numbers(out.tolist())


def _assigned(rows: DataFrame, books: list[np.ndarray], keep: list[str], last: bool) -> DataFrame:
    parts, width = books[-1].shape[0], books[-1].shape[0] * books[-1].shape[2]
    known = "code" in rows.columns

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, STEP):
                b = whole.slice(a, STEP)
                bounds = Bounds.read(b, parts) if known else Bounds(b.num_rows, parts)
                error, _ = assign(integers(b.column("embedding"), width), bounds, books, last)
                out = {c: b.column(c) for c in keep}
                if last:
                    out |= {"code": _binaries(bounds.code), "error": pa.array([min(int(e), _MOST) for e in error], pa.int64())}
                else:
                    out |= {"embedding": b.column("embedding")} | bounds.columns()
                yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    fields = [rows.schema[c] for c in keep]
    if last:
        fields += [T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType())]
    else:
        fields += [rows.schema["embedding"]] + [T.StructField(n, T.BinaryType()) for n in Bounds.NAMES]
    return rows.mapInArrow(each, T.StructType(fields))


def compressed(vectors: DataFrame, *keep: str, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[list[list[int]]]]:
    """((vec_id, keep..., code, error) of every row with a finite vector, codebooks by part and entry).

    ``code`` has one byte per part; ``error`` is the exact squared distance to the code's entries in
    integer components, at most 2**63 - 1. Codebooks start with the ``entries`` smallest vec_ids (a null
    id last, equal ids by their vector), fewer if there are fewer rows. Null vectors and those with null
    or non-finite components are left out; zero vectors and repeated rows take part. Vectors whose length
    is no multiple of ``parts``, or that are shorter than the longest, count as filled up with zeros.
    An empty table gives no rows and empty codebooks.
    """
    spark = vectors.sparkSession
    importable(spark)
    rows = vectors.filter(finite(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), *keep, "embedding")
    fields = ["vec_id", *keep]
    longest = rows.agg(F.max(F.size("embedding"))).first()[0]
    if longest is None:
        return rows.select(*fields, F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error")), []
    width = -(-max(longest, 1) // parts) * parts
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").select("embedding").limit(entries).toArrow()
    start = integers(first.column("embedding"), width)
    books = [_numbers(start.reshape(len(start), parts, width // parts).swapaxes(0, 1).tolist())]
    at = None
    for _ in range(rounds):
        rows, written_at = stored(_assigned(rows, books, fields, False), "vector-bounds")
        if at:
            removed(spark, at)
        at = written_at
        books.append(updated(books[-1], _sums(rows, parts, width, len(start))))
    done, _ = stored(_assigned(rows, books, fields, True), "vector-codes")
    if at:
        removed(spark, at)
    return done, [[[int(v) for v in entry] for entry in part] for part in books[-1]]


def codebooks_sha256(books: list[list[list[int]]]) -> str:
    return hashlib.sha256(",".join(str(v) for part in books for entry in part for v in entry).encode()).hexdigest()


def with_label_errors(rows: DataFrame, label: str = "label", salt: int = SALT) -> DataFrame:
    """The rows with ``label_error``, the error summed over rows of equal label (nulls together; at most
    2**63 - 1). A label with many rows is dealt over ``salt`` keys on the way back."""
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_MOST).cast("decimal(38,0)")).cast("long")
    sums = rows.groupBy(F.col(label).alias("of_label")).agg(total.alias("label_error"))
    sums = sums.withColumn("of_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(salt)).cast("int"))
    on = dealt[label].eqNullSafe(sums["of_label"]) & (dealt["salt"] == sums["of_salt"])
    return dealt.join(sums, on).select(*rows.columns, "label_error")


def decoded(codes: DataFrame, books: list[list[list[int]]], spark: SparkSession | None = None) -> DataFrame:
    """The rows with ``approximate``, the vector that a code stands for (its entries' centres, unscaled)."""
    if not books:
        return codes.withColumn("approximate", F.lit(None).cast("array<double>"))
    book = _numbers(books).astype(np.float64)
    parts = book.shape[0]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code = np.frombuffer(b"".join(b.column("code").to_pylist()), dtype=np.uint8).reshape(-1, parts)
            x = ((book[np.arange(parts), code] + 0.5) / SCALE).reshape(len(code), -1)
            yield b.append_column("approximate", pa.array(x.tolist(), pa.list_(pa.float64())))

    return codes.mapInArrow(each, T.StructType([*codes.schema.fields, T.StructField("approximate", T.ArrayType(T.DoubleType()))]))
