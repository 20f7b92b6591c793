"""Session helpers: building a local session for tests/bench and resolving
the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import os
import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


#: Says that a file: checkpoint folder is a mount that all machines of the cluster share.
SHARED_FILE_CONF = "shopscope.checkpoint.sharedMount"


def _local_driver_memory() -> str:
    """60 % of physical memory (capped at 16 GB) for the single local JVM."""
    env = os.environ.get("SHOPSCOPE_DRIVER_MEM")
    if env:
        return env
    try:
        total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    except (ValueError, OSError, AttributeError):
        return "4g"
    mb = max(1024, min(16 * 1024, int(total * 0.6 / 2 ** 20)))
    return f"{mb}m"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "shopscope", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the benchmark (never used on a cluster)."""
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", _local_driver_memory()))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_WRITING_LOCK = threading.Lock()
_WRITING: dict[int, list] = {}
#: Input bytes that one shuffle partition stands for, and folders that a task writes at a time.
PARTITION_BYTES = 8 << 20
OPEN_FOLDERS = 32


@contextmanager
def writing(spark: SparkSession, input_bytes: int = 0) -> Iterator[None]:
    """Settings for writing tables made of so many bytes of input, set back when the last of the
    writers that overlap has ended. Shuffles start from partitions by the input's size (AQE puts small
    ones together), so a task's share stays in memory at every size. A task that meets few folders
    keeps a file open for each instead of sorting its rows by folder first; one that meets more
    sorts the rest."""
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), input_bytes // PARTITION_BYTES)
    wanted = {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FOLDERS)}
    if input_bytes:
        wanted["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(parts)
    with _WRITING_LOCK:
        now = _WRITING.setdefault(id(spark), [0, {k: spark.conf.get(k, None) for k in wanted}])
        now[0] += 1
        if now[0] == 1:
            for k, v in wanted.items():
                spark.conf.set(k, v)
    try:
        yield
    finally:
        with _WRITING_LOCK:
            now[0] -= 1
            if not now[0]:
                for k, v in _WRITING.pop(id(spark))[1].items():
                    spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for durable intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). Only a local-mode session without one gets a private
    temporary folder; on a cluster a missing setting is an error, because a
    machine-local folder would not survive executor loss.
    """
    jsc = spark.sparkContext._jsc  # noqa: SLF001 - public accessor of the JVM context
    current = jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.sparkContext.master
    one_machine = master == "local" or master.startswith("local[") or master.startswith("local-cluster[")
    if conf_dir:
        if conf_dir.startswith("file:") and not one_machine and spark.conf.get(SHARED_FILE_CONF, "false") != "true":
            raise RuntimeError(f"spark.checkpoint.dir is a file: path; set {SHARED_FILE_CONF} only if all machines share it")
        spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="shopscope-ckpt-")
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()  # noqa: SLF001


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    return checkpoint_dir(spark)
