"""Loads that are repeated or killed without harm: staged folders and a ledger.

A table is the folders that the newest ledger entry names for it. A load writes
each of its tables into a new folder, which nothing reads yet, and then adds one
small file to the ledger that names all of them: the load becomes visible as a
whole or not at all. A load that is killed leaves folders that no entry names
(``vacuum`` deletes them); a load that is repeated under its id takes the place
of the earlier one instead of appending to it. An entry file is created only
where there is none, so of two loads that publish at once one has to try again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


class Ledger:
    """The loads of the tables under the folder ``root`` (any file system that Spark writes to)."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt
        self._entries = f"{self.root}/_ledger"

    # ------------------------------------------------------------ files
    def _at(self, path: str):
        jvm = self.spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FileSystem through the public gateway
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p  # noqa: SLF001

    def _names(self, path: str) -> list[str]:
        fs, p = self._at(path)
        return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []

    def _entry(self, version: int) -> str:
        return f"{self._entries}/{version:010d}.json"

    # ------------------------------------------------------------ state
    def _newest(self) -> tuple[int, dict[str, dict[str, str]]]:
        """(number of the last entry file, loads by id: table -> folder). A file that a killed load has
        not finished counts as taken but says nothing."""
        versions = [int(n[:-5]) for n in self._names(self._entries) if n.endswith(".json") and n[:-5].isdigit()]
        last = max(versions, default=0)
        for v in sorted(versions, reverse=True):
            try:
                return last, json.loads(self.spark.read.text(self._entry(v), wholetext=True).first()[0])["loads"]
            except (ValueError, TypeError, KeyError):
                continue
        return last, {}

    def loads(self) -> list[str]:
        return sorted(self._newest()[1])

    def folders(self, table: str) -> list[str]:
        return [at[table] for _, at in sorted(self._newest()[1].items()) if table in at]

    def read(self, table: str, only: Callable[[str], bool] | None = None) -> DataFrame:
        """The rows of a table; ``only``: of the loads whose id it holds for."""
        found = [at[table] for load, at in sorted(self._newest()[1].items()) if table in at and (only is None or only(load))]
        if not found:
            raise LookupError(f"no load of {table}")
        # the schema is stored with the rows: no folder is read to find it out but the first
        schema = self.spark.read.format(self.fmt).load(found[0]).schema
        return self.spark.read.schema(schema).format(self.fmt).load(found)

    # ------------------------------------------------------------ loads
    def load(self, load_id: str, tables: dict[str, DataFrame], partitions: dict[str, list[str]] | None = None) -> None:
        """Write the tables in their order and publish them together as ``load_id``."""
        staged = {}
        for name, df in tables.items():
            staged[name] = f"{self.root}/{name}/{uuid.uuid4().hex}"
            df.write.mode("errorifexists").partitionBy(*(partitions or {}).get(name, [])).format(self.fmt).save(staged[name])
        self.publish({load_id: staged})

    def publish(self, loads: dict[str, dict[str, str]], attempts: int = 20) -> None:
        """Name the folders of some loads, in place of what the ledger had under their ids."""
        for _ in range(attempts):
            last, known = self._newest()
            fs, p = self._at(self._entry(last + 1))
            try:
                out = fs.create(p, False)
            except Exception as taken:  # noqa: BLE001 - py4j wraps the file system's own exception
                if not fs.exists(p):
                    raise taken
                continue
            out.write(json.dumps({"loads": {**known, **loads}}).encode())
            out.close()
            return
        raise RuntimeError("other loads kept publishing first")

    def vacuum(self) -> list[str]:
        """Delete the folders of tables that the newest entry doesn't name; not while a load or a reader
        of an earlier entry runs."""
        named = {f for at in self._newest()[1].values() for f in at.values()}
        gone: list[str] = []

        def sweep(path: str) -> None:
            if path in named:
                return
            if any(n.startswith(path + "/") for n in named):  # some months of a load are still named
                for name in self._names(path):
                    sweep(f"{path}/{name}")
                return
            fs, p = self._at(path)
            fs.delete(p, True)
            gone.append(path)

        for table in self._names(self.root):
            if not table.startswith("_"):
                for name in self._names(f"{self.root}/{table}"):
                    sweep(f"{self.root}/{table}/{name}")
        return gone
