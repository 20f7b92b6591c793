"""Training-data pipeline over the table ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
reread as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopscope.llm.mixing import mixed
from shopscope.llm.ngram_join import one_of_each
from shopscope.llm.packing import best_fit_packing
from shopscope.llm.pii import redacted
from shopscope.llm.shared import importable, removed, stored, table
from shopscope.llm.subword_classifier import THRESHOLD, labelled, scores, trained


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores at least at its threshold."""
    importable(spark)
    model = trained(docs, labelled(table(spark, sf_dir, "labels")))
    scored = scores(docs, model, *docs.columns)
    return scored.filter(F.col(scored.columns[-1]) >= THRESHOLD).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    importable(spark)
    return one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind; n_chars follows the text."""
    clean = redacted(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their source takes them."""
    return mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their sequence and place."""
    importable(spark)
    return best_fit_packing(docs)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("personal data", personal_data),
    ("source mixing", mix),
    ("best-fit packing", pack),
]

#: SQL cannot express a trained classifier or a tokenizer; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, at = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        before = at
        docs, at = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if before:  # a stage's table goes when the next one is written
            removed(spark, before)
    return docs
