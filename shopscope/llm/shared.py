"""Shared folder and tables between stages.

Executors and driver share only the folder that the cluster names in
``spark.checkpoint.dir``. Tables written there are committed by Spark's file
protocol, so later stages read each row once however often tasks were retried.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of a text: runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """Folder of ``spark.checkpoint.dir``; a private one only where it is unset and all of Spark runs
    in one process (tests). On a cluster executors would each write to a disk of their own."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


#: Folder of the tables that ``made`` removes; none outside of it.
_STEPS: ContextVar[str | None] = ContextVar("steps", default=None)


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{_STEPS.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows as a table in the shared folder, reread, and where it is: for tables that are ``removed``
    when what follows from them is written."""
    spark = df.sparkSession
    at = new_folder(spark, name)
    df.write.parquet(at)
    return spark.read.schema(df.schema).parquet(at), at


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder, reread: cuts lineage and survives lost executors."""
    return stored(df, name)[0]


def removed(spark: SparkSession, *folders: str) -> None:
    """Delete folders that this run has written and nothing reads any more."""
    for at in folders:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)  # noqa: SLF001 - Hadoop FileSystem through the public gateway
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)  # noqa: SLF001


def made(spark: SparkSession, name: str, rows: Callable[[], DataFrame]) -> DataFrame:
    """The rows that the function gives as a table in the shared folder, reread. The tables that it
    writes on the way are removed: nothing else may read them."""
    at, steps = new_folder(spark, name), new_folder(spark, f"{name}-steps")
    outer = _STEPS.set(steps)
    try:
        df = rows()
        df.write.parquet(at)
    finally:
        _STEPS.reset(outer)
        removed(spark, steps)
    return spark.read.schema(df.schema).parquet(at)


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that the frame doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Bits of a row's place in its file; the bits above hold the file.
PLACE_BITS = 33


def _numbered_by_place(docs: DataFrame, name: str, *columns: Column | str) -> DataFrame | None:
    """``numbered`` without a copy, where the rows are those of whole files that tell a row's place:
    file and place are the same in every scan. None for other frames, and where two files get one number."""
    if not docs.inputFiles() or "_metadata" in docs.columns:
        return None
    file = F.pmod(F.xxhash64("_metadata.file_path"), F.lit(1 << (63 - PLACE_BITS)))
    try:
        place = docs.select(file.alias("file"), F.col("_metadata.row_index").alias("place"))
        rows = docs.select(F.shiftleft(file, PLACE_BITS).bitwiseOR(F.col("_metadata.row_index")).alias(name), *columns)
    except AnalysisException:
        return None
    # every place of every file once: a filter leaves some out, a join or explode repeats some
    places = place.groupBy("file", "place").agg(F.count(F.lit(1)).alias("n"))
    files = places.groupBy("file").agg(F.count(F.lit(1)).alias("places"), F.sum("n").alias("rows"), F.max("place").alias("last"))
    return rows if files.filter("places != rows or places != last + 1").isEmpty() else None


def numbered(docs: DataFrame, name: str, *columns: Column | str) -> DataFrame:
    """The rows (or these columns of them) with a number each in column ``name``, the same in every
    scan. Rows of Parquet files are numbered by file and place there; the files must stay while the
    rows are read. Other rows are numbered as they come and written once: a second scan may be split
    otherwise, when executors come or go, and would number them anew."""
    columns = columns or tuple(docs.columns)
    placed = _numbered_by_place(docs, name, *columns)
    return written(docs.select(F.monotonically_increasing_id().alias(name), *columns), "rows") if placed is None else placed


def bitmap(names: DataFrame, column: str, bits: int) -> np.ndarray:
    """Which of ``bits`` (a power of two) places the names fall on, as words of 64 bits. A filter of
    fixed size: it passes every name it was made of and, the fuller it is, others."""
    place = f"(({column} ^ shiftrightunsigned({column}, 20) ^ shiftrightunsigned({column}, 43)) & {bits - 1}L)"
    words = names.select(F.expr(f"shiftright({place}, 6)").alias("word"), F.expr(f"shiftleft(1L, cast({place} & 63 as int))").alias("bit"))
    found = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()  # bits / 64 rows at most
    out = np.zeros(bits // 64, dtype=np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out.view(np.uint64)


def passes(bits: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Which names may be in the bitmap."""
    n = names.astype(np.int64, copy=False).view(np.uint64)
    # row numbers differ in high bits (the task) and in low ones
    place = ((n ^ (n >> np.uint64(20)) ^ (n >> np.uint64(43))) & np.uint64(len(bits) * 64 - 1)).astype(np.int64)
    return (bits[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


def filtered(rows: DataFrame, column: str, bits: np.ndarray) -> DataFrame:
    """Rows whose (not null) name may be in the bitmap."""

    def keep(batches):
        import pyarrow as pa

        for b in batches:
            yield b.filter(pa.array(passes(bits, b.column(column).to_numpy())))

    return rows.mapInArrow(keep, rows.schema)


#: Bits of the filter that parts rows (2 MB as a broadcast table at most, by words of 64 bits).
PART_BITS = 1 << 23


def parted(rows: DataFrame, column: str, names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose (not null) value may be among the ``names`` in the column of that name, and the others. The
    bitmap that tells them apart has a fixed size and is broadcast: rows are not shuffled. DataFrame functions only."""
    word, bits, bit = (unused(rows, x) for x in ("part_word", "part_bits", "part_bit"))
    place = F.pmod(F.xxhash64(column), F.lit(PART_BITS))
    marked = lambda df, *keep: df.select(*keep, F.shiftright(place, 6).alias(word), place.alias(bit)).withColumn(bit, F.expr(f"shiftleft(1L, cast(`{bit}` & 63 as int))"))
    known = marked(names).groupBy(word).agg(F.bit_or(bit).alias(bits))  # PART_BITS / 64 rows at most
    seen = marked(rows, *rows.columns).join(F.broadcast(known), word, "left")
    may = F.coalesce(F.col(bits).bitwiseAND(F.col(bit)) != 0, F.lit(False))
    return seen.filter(may).select(*rows.columns), seen.filter(~may).select(*rows.columns)


def importable(spark: SparkSession) -> None:
    """Let Python workers of this machine import the package from where the driver did.
    (A cluster gets it installed or with --py-files.)"""
    env, root = spark.sparkContext.environment, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))


#: Bytes of an Arrow batch: executor and Python worker each hold one or two of them per task.
ARROW_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Let Spark cut Arrow batches at ``ARROW_BYTES``; a smaller setting of the session stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key)
    if not now.rstrip("b").isdigit() or not 0 < int(now.rstrip("b")) <= ARROW_BYTES:
        spark.conf.set(key, str(ARROW_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Number of words of a text as BIGINT, 0 for null: words start where white
    space (or nothing) is followed by something else."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))
