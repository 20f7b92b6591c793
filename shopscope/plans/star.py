"""Star schema build (C-60) and its materialisation.

raw sales -> clean sales -> dim_customer, dim_product, dim_date,
fact_sales, rfm_segments. Written once as Parquet in the shared checkpoint
folder (like the cleaned and segment files plus the database load of the
original workflow), then every report reads the written tables. A table is
written when it is first read, so a report on segments does not wait for the
fact; ``materialize_star`` writes them all. Overwrite semantics make a re-run
idempotent.

"First" (dimension attributes) is defined by a total order, not by file
order: (invoice_ts, invoice, stock_code, quantity, price, country,
description), nulls first. The earliest time per key is a hash aggregate with
map-side combine; only lines of that time meet the full order
(``plans.marks.first_rows``), so a customer or product holding a third of all
lines does not land in one task the way a keyed window would.
"""

from __future__ import annotations

import os
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopscope import schemas
from shopscope.functions.calendar import is_q4
from shopscope.operators import cleaning, rfm
from shopscope.plans.marks import first_rows
from shopscope.plans.ordering import global_order
from shopscope.session import checkpoint_dir, writing
from shopscope.sources.sinks import observed

_DERIVED_LOCK = threading.RLock()

FIRST_ORDER = ["invoice_ts", "invoice", "stock_code", "quantity", "price", "country", "description"]
SALE_ORDER = ["invoice_ts", "invoice", "stock_code", "quantity", "price", "customer_id",
              "country", "description"]
#: The part of it that a fact line shows: lines that differ in the rest alone are the same fact lines,
#: so the fact is numbered without moving and comparing their text.
FACT_ORDER = SALE_ORDER[:6]


def dim_customer(clean: DataFrame, n_rows: int | None = None) -> DataFrame:
    return first_rows(clean, "customer_id", "country", FIRST_ORDER, n_rows)


def dim_product(clean: DataFrame, n_rows: int | None = None) -> DataFrame:
    return first_rows(clean, "stock_code", "description", FIRST_ORDER, n_rows)


def date_attributes(date_col: str = "date_id") -> list:
    d = F.col(date_col)
    return [d.alias("date_id"),
            F.year(d).alias("year"), F.month(d).alias("month"),
            F.dayofmonth(d).alias("day"), F.quarter(d).alias("quarter"),
            F.date_format(d, "MMMM").alias("month_name"),
            is_q4(d).cast("int").alias("is_q4")]


def dim_date(clean: DataFrame) -> DataFrame:
    days = clean.select(F.to_date("invoice_ts").alias("date_id")).distinct()
    return days.select(*date_attributes())


def sale_month(ts: str) -> Column:
    """The calendar month of a line as a number (yyyymm)."""
    return (F.year(ts) * 100 + F.month(ts)).cast("int").alias("sale_month")


def fact_sales(clean: DataFrame, n_rows: int | None = None) -> DataFrame:
    """Fact lines with a dense ``sale_id`` over the total line order. ``n_rows``: how many there are, if
    known.

    The global order leaves the fact range-partitioned by sale_id (hence by
    time), so each task writes into the folders of a few months. ``sale_month``
    (yyyymm) is what the written fact is partitioned by."""
    ordered = global_order(clean.select(*FACT_ORDER, "revenue"), [(c, True) for c in FACT_ORDER], rows=n_rows)
    return ordered.select(
        F.col("_rn").alias("sale_id"), "invoice", "customer_id", "stock_code",
        F.to_date("invoice_ts").alias("date_id"), "quantity",
        F.col("price").cast(schemas.PRICE2).alias("price"),
        F.col("revenue").cast(schemas.REV2).alias("revenue"),
        sale_month("invoice_ts"))


#: Columns that a written table's folders are named by.
PARTITIONS = {"fact_sales": ["sale_month"]}


@dataclass
class Star:
    raw: DataFrame
    clean: DataFrame
    classified: DataFrame
    dim_customer: DataFrame
    dim_product: DataFrame
    dim_date: DataFrame
    fact_sales: DataFrame
    rfm_segments: DataFrame
    location: str | None = None
    #: what the writes of the tables have observed of their rows (``sinks.checks``)
    metrics: dict[str, dict] | None = None

    def derived(self, name: str, build) -> DataFrame:
        """A table derived from the star (e.g. per-customer CLV), written once
        next to the star tables and read back by every later caller."""
        cache = self.__dict__.setdefault("_derived", {})
        with _DERIVED_LOCK, self.settings():
            return self._derived_locked(cache, name, build)

    def settings(self):
        """What holds while tables are written."""
        return nullcontext()

    def _derived_locked(self, cache: dict, name: str, build) -> DataFrame:
        if name not in cache:
            df = build(self)
            if self.location is None:
                cache[name] = df
            else:
                path = f"{self.location}/{name}"
                df.write.mode("overwrite").parquet(path)
                cache[name] = self.clean.sparkSession.read.parquet(path)
        return cache[name]

    def tables(self) -> dict[str, DataFrame]:
        """The tables with their declared columns."""
        return {"clean_sales": self.clean, "dim_customer": self.dim_customer,
                "dim_product": self.dim_product, "dim_date": self.dim_date,
                "fact_sales": self.fact_sales.select(*schemas.FACT_SALES.names), "rfm_segments": self.rfm_segments}

    def register_views(self, prefix: str = "") -> None:
        """Views for ``spark.sql``; the fact with ``sale_month``, which prunes partitions."""
        for name, df in {**self.tables(), "fact_sales": self.fact_sales}.items():
            df.createOrReplaceTempView(prefix + name)


def build_star(raw: DataFrame) -> Star:
    """Lazy star schema over ``raw`` (nothing is written)."""
    classified = cleaning.classify(raw)
    clean = cleaning.clean_from_classified(classified)
    return Star(raw=raw, clean=clean, classified=classified, dim_customer=dim_customer(clean),
                dim_product=dim_product(clean), dim_date=dim_date(clean),
                fact_sales=fact_sales(clean),
                rfm_segments=rfm.rfm_segments(clean))


class StoredStar(Star):
    """A star whose tables are written under ``location`` when they are first read, each once, and
    read from there."""

    #: in the order in which they are written where all are wanted
    TABLES = ("dim_customer", "dim_product", "dim_date", "fact_sales", "rfm_segments")

    def __init__(self, source: DataFrame, location: str, fmt: str = "parquet", input_bytes: int = 0) -> None:
        self.source, self.location, self.fmt, self.input_bytes = source, location, fmt, input_bytes
        self.spark = source.sparkSession
        self._read: dict[str, DataFrame] = {}
        self._seen: dict[str, dict] = {}
        self._rows: dict[str, int] = {}
        self._locks = {n: threading.RLock() for n in ("raw_sales", "classified_sales", "rows", *self.TABLES)}

    def settings(self):
        return writing(self.spark, self.input_bytes)

    def _table(self, name: str, build: Callable[[], DataFrame], *by: str) -> DataFrame:
        with self._locks[name]:
            if name not in self._read:
                with self.settings():
                    df, seen, path = build(), None, f"{self.location}/{name}"
                    if name in self.TABLES:
                        df, seen = observed(df, schemas.PRIMARY_KEYS[name], schemas.NOT_NULL[name])
                    df.write.mode("overwrite").partitionBy(*by).format(self.fmt).save(path)
                    if seen is not None:
                        self._seen[name] = seen.get
                self._read[name] = self.spark.read.format(self.fmt).load(path)
            return self._read[name]

    def _n(self, df: DataFrame, name: str) -> int:
        """How many rows a written table has (Parquet counts them in its footers)."""
        with self._locks["rows"]:
            if name not in self._rows:
                self._rows[name] = df.count()
            return self._rows[name]

    @property
    def raw(self) -> DataFrame:
        # the raw lines are loaded once (the audits and the guest analysis read
        # them too), then everything else derives from the written copy
        return self._table("raw_sales", lambda: self.source)

    @property
    def classified(self) -> DataFrame:
        # one de-duplication: distinct rows with copies and first failing step
        # in a folder per step: the clean table is the folder of the last one, not another copy
        return self._table("classified_sales", lambda: cleaning.classify(self.raw, self._n(self.raw, "raw")), "step_no")

    @property
    def clean(self) -> DataFrame:
        return cleaning.clean_from_classified(self.classified)

    def _clean(self) -> tuple[DataFrame, int]:
        clean = self.clean
        return clean, self._n(clean, "clean")

    @property
    def dim_customer(self) -> DataFrame:
        return self._table("dim_customer", lambda: dim_customer(*self._clean()))

    @property
    def dim_product(self) -> DataFrame:
        return self._table("dim_product", lambda: dim_product(*self._clean()))

    @property
    def dim_date(self) -> DataFrame:
        return self._table("dim_date", lambda: dim_date(self.clean))

    @property
    def fact_sales(self) -> DataFrame:
        return self._table("fact_sales", lambda: fact_sales(*self._clean()), *PARTITIONS["fact_sales"])

    @property
    def rfm_segments(self) -> DataFrame:
        return self._table("rfm_segments", lambda: rfm.rfm_segments(self.clean))

    def tables(self) -> dict[str, DataFrame]:
        """The tables with their declared columns, all written. The five depend only on the clean lines:
        they are written by concurrent jobs, so small stages of one overlap the others."""
        self._clean()
        workers = int(os.environ.get("SHOPSCOPE_STAR_WRITERS", len(self.TABLES)))
        with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
            list(pool.map(lambda n: getattr(self, n), self.TABLES))
        return super().tables()

    @property
    def metrics(self) -> dict[str, dict]:
        """What the writes of the five tables have observed of their rows (``sinks.checks``)."""
        self.tables()
        return dict(self._seen)


def stored_star(raw: DataFrame, path: str | None = None, *, fmt: str = "parquet", input_bytes: int = 0) -> StoredStar:
    """A Star that writes each table when it is first read."""
    if path is None:
        path = os.path.join(checkpoint_dir(raw.sparkSession), "shopscope-star", uuid.uuid4().hex)
    return StoredStar(raw, path, fmt, input_bytes)


def materialize_star(raw: DataFrame, path: str | None = None, *,
                     fmt: str = "parquet") -> Star:
    """Write the classified lines, then the star tables derived from them,
    and return a Star that reads the written files."""
    star = stored_star(raw, path, fmt=fmt)
    star.tables()
    return star


_CACHE: dict[tuple, Star] = {}
_LOCK = threading.Lock()


INPUTS = ("lineitem", "orders", "customer", "nation", "part")


@dataclass(frozen=True)
class _File:
    path: str
    length: int
    modificationTime: int  # noqa: N815 - as the file system names it


def _files(spark: SparkSession, path: str) -> list[_File]:
    """The files of a table, through the file system that holds it."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001 - Hadoop FileSystem through the public gateway
    found = p.getFileSystem(sc._jsc.hadoopConfiguration()).listStatus(p)  # noqa: SLF001
    return [_File(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in found]


def star_for(spark: SparkSession, sf_dir: str) -> Star:
    """The stored star for ``sf_dir`` in this application (each table written once,
    also when several threads ask at the same time)."""
    from shopscope.sources.raw_view import raw_sales_from_tpch

    # another listing of the input files is another star
    files = [f for t in INPUTS for f in _files(spark, f"{sf_dir.rstrip('/')}/{t}.parquet")]
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), tuple(sorted(f"{f.path}:{f.length}:{f.modificationTime}" for f in files)))
    with _LOCK:
        if key not in _CACHE:
            _CACHE[key] = stored_star(raw_sales_from_tpch(spark, sf_dir), input_bytes=sum(f.length for f in files))
        return _CACHE[key]
