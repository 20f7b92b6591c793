"""Classifier on held-out rows, and the pipeline against its parts."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from shopscope.llm import subword_classifier as sc
from shopscope.llm.queries import QUERIES
from shopscope.llm.shared import table

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    got = sc.quality(table(spark, SF, "documents"), table(spark, SF, "labels"))
    rows = got.join(table(spark, SF, "labels"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 500 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert np.mean([r.predicted == r.quality for r in held]) >= 0.97
    good = [r for r in held if r.quality == 1]
    assert np.mean([r.predicted for r in good]) >= 0.99


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int")


def test_scores_do_not_depend_on_held_out_labels_or_order(spark, docs):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["good", "fine", "text"] if i % 2 else ["bad***", "b@d", "junk$$$"]) for _ in range(30))) for i in range(80)]
    rows += [(100, None), (101, ""), (None, "good text"), (5, rows[5][1])]
    marks = [(i, i % 2) for i in range(80)]
    other = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q) for i, q in marks] + [(None, 0), (7, None), (999, 1)]
    one = sorted(map(str, sc.quality(docs(rows), _labels(spark, marks)).collect()))
    two = sorted(map(str, sc.quality(docs(rows, 1), _labels(spark, other)).collect()))
    assert one == two and len(one) == len(rows)


def test_without_labels_and_without_rows(spark, docs):
    none = _labels(spark, [])
    assert {r.score for r in sc.quality(docs([(1, "a b"), (2, None)]), none).collect()} == {0.5}
    assert sc.quality(docs([]), none).count() == 0
    assert sc.quality(docs([]), _labels(spark, [(1, 1)])).count() == 0


def test_pair_features_end_with_the_text():
    import pyarrow as pa

    bucket, first, which, pair, bounds = sc.features(pa.array(["a a b", "", None, "c"]))
    assert bounds.tolist() == [0, 3, 3, 3, 4] and (pair == -1).tolist() == [False, False, True, True] and pair[0] == 1
    assert len(bucket) == first[-1] and (bucket >= 0).all() and (bucket < sc.BUCKETS).all()


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    sf, at = "/root/testdata/sf0.01", tmp_path_factory.mktemp("stages")
    now, out = table(spark, sf, "documents"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, sf).write.parquet(f"{at}/{i}")
        out.append((now, spark.read.parquet(f"{at}/{i}")))
        now = out[-1][1]
    return out


def test_stages_keep_the_columns(stages):
    for before, after in stages[:-1]:
        assert after.columns == before.columns


def test_stage_decisions(spark, stages):
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    (docs, good), (_, single), (_, clean), (_, mix), (_, packed) = stages
    kept = QUERIES["op7_subword_classifier"](spark, "/root/testdata/sf0.01").filter("predicted = 1")
    assert ids(good) == ids(kept)
    from test_ngrams import _components

    rows = [(r.doc_id, r.text) for r in good.collect()]
    assert ids(single) == sorted({c for _, _, c in _components(rows)})
    from test_native import _base

    before, after = ({r.doc_id: r.text for r in df.collect()} for df in (single, clean))
    assert ids(single) == ids(clean)
    assert all(after[i] == t for i, t in before.items() if not _base(t) and not any(c.isdigit() for c in t))
    assert not any(_base(t) for t in after.values())
    words = sum(len(t.split()) for t in after.values())
    total = sum(len(r.text.split()) for r in mix.collect())
    assert abs(total / words - 1.5) < 0.1
    assert max(ids(mix).count(i) for i in set(ids(mix))) <= 2
    assert set(ids(packed)) == set(ids(mix))


def test_stages_keep_columns_with_clashing_names(spark, tmp_path):
    names = ["quality_score", "label", "key", "row", "group_row", "pii_row", "pii_cuts", "mix_row", "size", "name", "Copy"]
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    now = docs.select("*", *(F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")).alias(n) for n in names))
    want = now.columns
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, now, "/root/testdata/sf0.001").write.parquet(f"{tmp_path}/{i}")
        now = spark.read.parquet(f"{tmp_path}/{i}")
        assert now.columns == want
        assert now.count() > 0 and all(r[n] == f"{n} {r.doc_id}" for r in now.collect() for n in names)


def test_stages_on_an_empty_table(spark, tmp_path):
    now = table(spark, "/root/testdata/sf0.001", "documents").filter("false")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, "/root/testdata/sf0.001").write.parquet(f"{tmp_path}/{i}")
        now = spark.read.parquet(f"{tmp_path}/{i}")
        assert now.count() == 0


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.01")
    key = lambda df: sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert key(got) == key(stages[-1][1])
