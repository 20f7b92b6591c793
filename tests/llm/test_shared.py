"""Row numbers without copies, tables that go when they were read, rows parted without a shuffle."""

import os
import random

import pytest
from pyspark.sql import functions as F

from shopscope.llm import mixing, pii
from shopscope.llm import ngram_join as nj
from shopscope.llm.shared import made, new_folder, numbered, parted, shared_dir, written

ROWS = [(i, f"first{i} " + " ".join(f"w{i}x{j}" for j in range(60)) + (f" m{i}@b.cc" if i % 4 == 0 else "")) for i in range(200)]


@pytest.fixture()
def frame(spark, docs, tmp_path):
    docs(ROWS + ROWS[:20], 5).write.parquet(str(tmp_path / "docs"))
    return spark.read.parquet(str(tmp_path / "docs"))


def _shared(spark, monkeypatch, tmp_path):
    """A shared folder of the test's own, as a plain path."""
    at = str(tmp_path / "shared")
    os.makedirs(at)
    monkeypatch.setattr("shopscope.llm.shared.shared_dir", lambda spark: f"file://{at}")
    return at


def _tables(at):
    return sorted({os.path.relpath(d, at) for d, _, files in os.walk(at) if any(f.endswith(".parquet") for f in files)})


def test_rows_of_files_are_numbered_without_a_copy(spark, frame, monkeypatch, tmp_path):
    at = _shared(spark, monkeypatch, tmp_path)
    key = "spark.sql.files.maxPartitionBytes"
    held = spark.conf.get(key)
    rows = numbered(frame, "no", "doc_id")
    first = sorted(map(tuple, rows.collect()))
    try:
        spark.conf.set(key, "2k")
        again = sorted(map(tuple, rows.collect()))
    finally:
        spark.conf.set(key, held)
    assert first == again and len({n for n, _ in first}) == len(ROWS) + 20 and min(first)[0] >= 0
    assert _tables(at) == []


@pytest.mark.parametrize("name", ["filter", "explode", "join", "union", "memory"])
def test_other_rows_are_numbered_in_a_copy(spark, docs, frame, monkeypatch, tmp_path, name):
    at = _shared(spark, monkeypatch, tmp_path)
    other = {
        "filter": lambda: frame.filter("doc_id % 3 = 0"),
        "explode": lambda: frame.withColumn("twice", F.explode(F.array(F.lit(1), F.lit(2)))).drop("twice"),
        "join": lambda: frame.join(frame.select(F.col("doc_id").alias("other")).filter("other < 50"), F.col("doc_id") % 2 == F.col("other") % 2).drop("other"),
        "union": lambda: frame.union(frame),
        "memory": lambda: docs(ROWS),
    }[name]()
    rows = numbered(other, "no", "doc_id")
    assert len(_tables(at)) == 1
    got = [r.no for r in rows.collect()]
    assert len(got) == len(set(got)) == other.count()


def test_tables_on_the_way_are_removed(spark, docs, monkeypatch, tmp_path):
    at = _shared(spark, monkeypatch, tmp_path)
    inner = lambda: made(spark, "inner", lambda: written(spark.range(5), "a")).filter("id > 1")
    out = made(spark, "outer", lambda: written(inner(), "b").union(written(spark.range(2), "c")))
    assert sorted(r.id for r in out.collect()) == [0, 1, 2, 3, 4]
    assert len(_tables(at)) == 1 and _tables(at)[0].startswith("outer-")
    with pytest.raises(ZeroDivisionError):
        made(spark, "none", lambda: written(spark.range(1 // 0), "d"))
    assert new_folder(spark, "x").startswith(f"file://{at}/x-")


def test_stages_leave_no_texts_in_the_shared_folder(spark, frame, monkeypatch, tmp_path):
    at = _shared(spark, monkeypatch, tmp_path)
    for stage in (nj.one_of_each, pii.redacted, mixing.mixed):
        out = stage(frame)
        left = _tables(at)
        assert not any("text" in spark.read.parquet(f"{at}/{t}").columns for t in left)
        assert len(left) == 1, (stage.__name__, left)
        assert out.count() > 0
        at = _shared(spark, monkeypatch, tmp_path / stage.__name__)


def test_edges_of_earlier_rounds_are_removed(spark, monkeypatch, tmp_path):
    at = _shared(spark, monkeypatch, tmp_path)
    from shopscope.llm.components import components

    found = components(spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long"))
    assert {r.component for r in found.collect()} == {0} and len(_tables(at)) == 1


def test_parted_rows(spark, docs):
    rng = random.Random(4)
    rows = spark.createDataFrame([(rng.getrandbits(62), i) for i in range(3000)], "part_bits long, part_word long")
    names = rows.filter("part_word % 5 = 0").select("part_bits")
    may, others = parted(rows, "part_bits", names)
    plan = may._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    assert may.columns == others.columns == rows.columns and "SortMergeJoin" not in plan
    may, others = ({tuple(r) for r in x.collect()} for x in (may, others))
    assert not may & others and len(may | others) == 3000
    assert {tuple(r) for r in rows.filter("part_word % 5 = 0").collect()} <= may and len(may) < 700
    assert shared_dir(spark)


def test_only_texts_with_cuts_are_shuffled(spark, frame):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = pii.redacted(frame)
        plan = got._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    assert "BroadcastHashJoin" in plan
    want = sorted((i, t.replace(f"m{i}@b.cc", "<EMAIL>")) for i, t in ROWS + ROWS[:20])
    assert sorted((r.doc_id, r.text) for r in got.collect()) == want


def test_plans_of_the_join_hold_no_step_twice(spark, monkeypatch, frame):
    from shopscope.llm import components, ngram_join, shared

    joins = {}

    def counted(df, name, write=shared.stored):
        plan = df._jdf.queryExecution().optimizedPlan().toString()  # noqa: SLF001
        joins[name] = max(joins.get(name, 0), plan.count("Join "))
        return write(df, name)

    for module in (shared, ngram_join, components):
        monkeypatch.setattr(module, "stored", counted)
    edges = spark.createDataFrame([(i, i + 1) for i in range(9)], "a long, b long")
    assert {r.component for r in components.components(edges).collect()} == {0}
    assert joins["edges"] <= 1  # a star has one join
    assert ngram_join.one_of_each(frame).count() > 0
    assert joins["linkable-members"] <= 1
