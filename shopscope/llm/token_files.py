"""Token ids as Arrow files of equal-length sequences with masks.

Documents are range-partitioned and sorted by id; each task encodes its share
and writes two Arrow IPC files (the random-access file format around Arrow's
stream) to the shared folder:

* ``*.ids.arrow``   ``input_ids`` fixed_size_list<uint16 or uint32>[length] and
  ``mask`` fixed_size_list<bool>[length]: the share's ids, one document after
  another, cut into equal sequences; the last one is padded, its mask false;
* ``*.docs.arrow``  doc_id, start (in the share) and n_tokens of each document.

File names are unique per attempt, and a file counts only if its row is in the
manifest, a Parquet table that Spark commits: a lost or repeated task leaves
at most unlisted files. ``TokenFile`` maps a local file into memory, so a
sequence or mask is a view of the file (zero-copy); on a remote store the same
reader fetches single record batches.

Nulls: a null text is empty (its end id only); a null doc_id sorts first.
Equal doc_ids are ordered by text hash; equal rows are interchangeable. An
empty table gives an empty manifest and result. Other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopscope.llm.shared import new_folder, written
from shopscope.llm.tokens import batches_by_bytes, encoder, tokenizer_path

SEQUENCE = 2048
#: Sequences per record batch: the unit of remote reads.
BATCH_SEQUENCES = 256
MANIFEST = "part long, ids_uri string, docs_uri string, n_docs long, n_tokens long"
DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long, sequence_part long"


def _open(uri: str, write: bool = False):
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    if write:
        store.create_dir(path.rpartition("/")[0], recursive=True)
        return store.open_output_stream(path)
    if isinstance(store, fs.LocalFileSystem):
        return pa.memory_map(path)
    return store.open_input_file(path)


class SequenceWriter:
    """Appends ids to an Arrow file of equal sequences; at most one record batch is held."""

    def __init__(self, uri: str, dtype: np.dtype, length: int):
        kind = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([("input_ids", pa.list_(pa.field("item", kind, False), length)),
                                 ("mask", pa.list_(pa.field("item", pa.bool_(), False), length))])
        self.dtype, self.length, self.n = dtype, length, 0
        self.sink = _open(uri, write=True)
        self.writer = pa.ipc.new_file(self.sink, self.schema)
        self.held: list[np.ndarray] = []
        self.n_held = 0

    def add(self, ids: np.ndarray) -> None:
        self.held.append(ids)
        self.n_held += len(ids)
        full = self.length * BATCH_SEQUENCES
        if self.n_held >= full:
            ids = np.concatenate(self.held)
            for a in range(0, len(ids) - full + 1, full):
                self._write(ids[a:a + full], full)
            self.held = [ids[len(ids) // full * full:]]
            self.n_held = len(self.held[0])

    def _write(self, ids: np.ndarray, real: int) -> None:
        mask = np.arange(len(ids)) < real
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), type=f.type) for x, f in zip((ids, mask), self.schema)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
        self.n += real

    def close(self) -> None:
        if self.n_held:
            ids = np.concatenate(self.held)
            self._write(np.concatenate([ids, np.zeros(-len(ids) % self.length, dtype=self.dtype)]), len(ids))
        self.writer.close()
        self.sink.close()


class TokenFile:
    """Random access to one file of sequences."""

    def __init__(self, uri: str):
        self.reader = pa.ipc.open_file(_open(uri))
        self.length = self.reader.schema.field("input_ids").type.list_size

    def _column(self, batch: int, name: str) -> np.ndarray:
        col = self.reader.get_batch(batch).column(name)
        flat = col.flatten()
        return flat.to_numpy(zero_copy_only=flat.type != pa.bool_())

    def sequence(self, i: int) -> np.ndarray:
        """Sequence i: a view of the file where it is mapped."""
        at = i % BATCH_SEQUENCES * self.length
        return self._column(i // BATCH_SEQUENCES, "input_ids")[at:at + self.length]

    def mask(self, i: int) -> np.ndarray:
        at = i % BATCH_SEQUENCES * self.length
        return self._column(i // BATCH_SEQUENCES, "mask")[at:at + self.length]

    def tokens(self, start: int, n: int) -> np.ndarray:
        """n ids from place ``start`` of the file on."""
        size, got = self.length * BATCH_SEQUENCES, []
        while n > 0:
            ids = self._column(start // size, "input_ids")[start % size:start % size + n]
            got.append(ids)
            start, n = start + len(ids), n - len(ids)
        return got[0] if len(got) == 1 else np.concatenate(got) if got else np.zeros(0, dtype="<u4")


def write_token_files(docs: DataFrame, folder: str, path: str | None = None, length: int = SEQUENCE, end_id: int = 1) -> DataFrame:
    """Write the files of ``docs`` under ``folder`` and return the manifest, one row per part."""
    path = path or tokenizer_path()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, enc, out = TaskContext.get().partitionId(), encoder(path), None
        name = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}"
        n_docs = n_tokens = 0
        for b in batches:
            done = 0
            for texts in batches_by_bytes(b.column(1)):
                ids, bounds = enc.flat(texts)
                ids = np.insert(ids, bounds[1:], end_id)
                sizes = np.diff(bounds) + 1
                if out is None:
                    out = SequenceWriter(f"{name}.ids.arrow", enc.dtype, length)
                    kind = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
                    sink = _open(f"{name}.docs.arrow", write=True)
                    index = pa.ipc.new_file(sink, kind)
                out.add(ids)
                starts = n_tokens + np.cumsum(sizes) - sizes
                index.write_batch(pa.RecordBatch.from_arrays([b.column(0).slice(done, len(texts)), pa.array(starts), pa.array(sizes)], schema=kind))
                done += len(texts)
                n_docs += len(texts)
                n_tokens += len(ids)
        if out is not None:
            out.close()
            index.close()
            sink.close()
            row = [part, f"{name}.ids.arrow", f"{name}.docs.arrow", n_docs, n_tokens]
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], ["part", "ids_uri", "docs_uri", "n_docs", "n_tokens"])

    order = [F.col("doc_id").asc_nulls_first(), "tie"]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # the hash deals out the rows of one id; sorting raw texts lets the encoder run once, after the shuffle
    rows = rows.withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    return written(rows.mapInArrow(write, MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start over all parts, n_tokens, crc32 of its ids."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                ids = TokenFile(row["ids_uri"])
                index = pa.ipc.open_file(_open(row["docs_uri"]))
                for i in range(index.num_record_batches):
                    some = index.get_batch(i)
                    starts, sizes = some.column("start").to_numpy(), some.column("n_tokens").to_numpy()
                    crc = [zlib.crc32(ids.tokens(a, n).astype("<u4")) for a, n in zip(starts.tolist(), sizes.tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [some.column("doc_id"), pa.array(starts + row["base"]), some.column("n_tokens"), pa.array(crc, type=pa.int64()), pa.array(np.full(len(some), row["part"]))],
                        ["doc_id", "start", "n_tokens", "ids_crc32", "sequence_part"])

    # one row per file: the running sum sees as many rows as there are files
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))
    files = max(1, manifest.count())
    return based.select("part", "ids_uri", "docs_uri", "base").repartitionByRange(files, "part").mapInArrow(read, DOCS)


def token_files(spark: SparkSession, docs: DataFrame, path: str | None = None, length: int = SEQUENCE, end_id: int = 1) -> DataFrame:
    """Write all documents and read the files back."""
    return read_token_files(write_token_files(docs, new_folder(spark, "token-files"), path, length, end_id))
