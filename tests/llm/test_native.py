"""Personal data and source mixing: plain re-computations, SQL, and plans without Python."""

import hashlib
import random
import re

import duckdb
import pytest

from shopscope.llm import mixing, pii
from shopscope.llm.queries import ORACLE, QUERIES

# the plain patterns of the query's contract
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ODD = [
    None, "", "call +1 (706) 555-3138 or (706) 555-3138", "a@b.com_x@d.e a@b..c @x.y a@b a@b.c.", "1.2.3.4.5.6.7.8 999.1.1.1 0.0.0.0255 1.2.3 00001.2.3.4",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111112 5 4111  1111", "😀 x@y.zz é +49 30 1234567 ü 10.0.0.1", "1" * 4000 + " " + "a" * 4000 + "@", "+" + "1 2" * 300 + "+123456789",
    "joe(at)mail.example(dot)com, 4111.1111.1111.1111", "a.b@c.d" * 50, "1-" * 2000, "+1+2+3 +1 2 (3) 4.5-6 7 8 9 0", "12 4111111111111111 x4111111111111111y",
]


def _luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _base(text):
    out = []
    for no, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and _luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), no, m.end(), kind))
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(out)]


def _pii_texts():
    rng = random.Random(4)
    number = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    parts = [
        lambda: f"u{number(2)}@mail{number(1)}.example.com", lambda: f"+1 ({number(3)}) 555-{number(4)}", lambda: f"{rng.randrange(300)}.{rng.randrange(300)}.{rng.randrange(300)}.{rng.randrange(300)}",
        lambda: "4111111111111111", lambda: number(16), lambda: f"({number(3)}) 555-{number(4)}", lambda: number(rng.randrange(1, 30)), lambda: rng.choice([" ", "-", ".", "+", "@", ", "]),
    ]
    texts = []
    for _ in range(250):
        words = [rng.choice(["the", "of", "tel", "mail", "in"]) for _ in range(rng.randrange(12))] + [rng.choice(parts)() for _ in range(rng.randrange(5))]
        rng.shuffle(words)
        texts.append(rng.choice([" ", "", " "]).join(words))
    return ODD + texts


def test_base_spans_equal_plain_patterns(docs):
    rows = [*enumerate(_pii_texts()), (None, "x@y.zz"), (6, ODD[6])]
    text = dict(rows)
    got = pii.pii_digest(docs(rows)).collect()
    assert len(got) == len(rows)
    added = 0
    for r in got:
        want = _base(text[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), r.doc_id
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k) for w in want) for k in PLAIN]
        spans = r.spans.split(",") if r.spans else []
        assert set(want) <= set(spans) and spans == sorted(spans, key=lambda s: (int(s.split(":")[1]), list(PLAIN).index(s.split(":")[0])))
        places = [tuple(map(int, s.split(":")[1:])) for s in spans if s not in want]
        base = [tuple(map(int, s.split(":")[1:])) for s in want]
        assert all(b <= c or d <= a for a, b in places for c, d in base)
        added += len(places)
    assert added > 0  # the trees generalise to numbers without a plus sign


def test_pii_without_candidates_and_empty(docs):
    assert pii.pii_digest(docs([])).count() == 0
    got = pii.pii_digest(docs([(1, None), (2, "plain words")])).collect()
    assert [(r.n_email, r.spans, r.base_sha256) for r in got] == [(0, "", hashlib.sha256(b"").hexdigest())] * 2


def test_redaction(docs):
    rows = [(1, "mail a@b.cc now 😀 1.2.3.4"), (2, None), (3, "clean"), (4, "+1 (706) 555-3138"), (4, "+1 (706) 555-3138"), (5, "")]
    frame = docs(rows)
    got = pii.redacted(frame)
    assert got.columns == frame.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([(1, "mail <EMAIL> now 😀 <IP>"), (2, None), (3, "clean"), (4, "<PHONE>"), (4, "<PHONE>"), (5, "")], key=str)


def _targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    want, full = 1.5 * sum(sizes.values()), set()
    while True:
        left = want - sum(2 * sizes[s] for s in full)
        open_w = sum(weight[s] for s in order if s not in full)
        over = {s for s in order if s not in full and weight[s] * left / open_w > 2 * sizes[s]}
        if not over:
            return {s: 2.0 * sizes[s] if s in full else weight[s] * left / open_w for s in order}
        full |= over


def test_mixture(spark, docs):
    rng = random.Random(1)
    docs([])
    data = [(i, " ".join(["w"] * rng.choice([0, 1, 3, 40, 700])), rng.choice(["a", "a", "a", "b", "ü", "Z", None])) for i in range(800)]
    data += [(None, "x y", "a"), (3, "x y z", "a"), (3, "x y z", "a"), (900, None, "empty"), (901, "w " * 30_000, "long"), (902, "one", "tiny")]
    frame = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(5)
    got = mixing.mixture(mixing.sized(frame)).collect()
    again = mixing.mixture(mixing.sized(frame.repartition(2))).collect()
    assert sorted(map(str, got)) == sorted(map(str, again)) and len(got) == len(data)
    sizes, taken = {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
        assert 0 <= r.taken <= 2 * r.size
    assert sorted((r.doc_id or -1, r.size) for r in got) == sorted((i or -1, len((t or "").split())) for i, t, _ in data)
    want = _targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source], rel=1e-12)
    assert all(abs(taken[s] - want[s]) <= mixing.BLOCK for s in sizes)


def test_mixture_without_words_and_mixed_rows(spark, docs):
    assert mixing.mixture(mixing.sized(docs([]))).count() == 0
    got = mixing.mixture(mixing.sized(docs([(1, None), (2, "")]))).collect()
    assert [(r.size, r.target, r.taken) for r in got] == [(0, 0.0, 0)] * 2
    frame = docs([(i, "w " * 500) for i in range(20)] + [(50, "")])
    rows = mixing.mixed(frame)
    assert rows.columns == frame.columns and 28 <= rows.count() <= 32


@pytest.mark.parametrize("n", [1, 2, 7, 100, 1001])
def test_permutation_is_one_to_one(spark, n):
    from pyspark.sql import functions as F

    df = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5).cast("long")).alias("p"))
    got = [r.p for r in df.collect()]
    assert sorted(got) == list(range(n))
    assert n < 100 or got != list(range(n))


def test_native_queries_run_no_python(spark, capsys):
    for name in ("op8_pii_candidates", "op10_source_mixing"):
        QUERIES[name](spark, "/root/testdata/sf0.001").explain("formatted")
    plan = capsys.readouterr().out
    assert not re.search("Python|Pandas|Arrow", plan) and "CartesianProduct" not in plan


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql_gives_the_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    want = con.sql(ORACLE[name])
    got = QUERIES[name](spark, "/root/testdata/sf0.001").select(*want.columns)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.fetchall()))


def test_rows_keep_their_numbers_when_a_later_scan_is_split_otherwise(spark, docs, tmp_path):
    texts = [f"number{i} " + " ".join(f"w{i}x{j}" for j in range(40)) + (f" m{i}@b.cc" if i % 3 == 0 else "") for i in range(60)]
    docs([(i, t) for i, t in enumerate(texts)]).repartition(6).write.parquet(str(tmp_path / "d"))
    frame = spark.read.parquet(str(tmp_path / "d"))
    key = "spark.sql.files.maxPartitionBytes"
    held = spark.conf.get(key)
    try:
        spark.conf.set(key, "128m")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        results = pii.redacted(frame)
        spark.conf.set(key, "2k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1m")
        texts_now = {r.doc_id: r.text for r in results.collect()}
    finally:
        spark.conf.set(key, held)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert texts_now == {i: t.replace(f"m{i}@b.cc", "<EMAIL>") for i, t in enumerate(texts)}


def test_mixed_rows_meet_the_target_of_each_source(spark, docs):
    docs([])
    rng = random.Random(2)
    data = [(i, "w " * rng.randint(1500, 4000), s) for i, s in enumerate(rng.choice("aaabbc") for _ in range(400))]
    frame = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(4)
    sizes, got = {}, {}
    for _, t, s in data:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    rows = mixing.mixed(frame).collect()
    for r in rows:
        got[r.source] = got.get(r.source, 0) + len(r.text.split())
    for s, want in _targets(sizes).items():
        assert abs(got.get(s, 0) / want - 1) <= 0.05, (s, got.get(s, 0), want)


def test_candidates_that_overlap_only_dropped_ones_stay(spark, docs):
    docs([])
    rows = [(1, "phone", 3, 0, 10, False), (1, "card", 2, 8, 20, False), (1, "phone", 3, 18, 30, False), (1, "ip", 1, 40, 44, False), (2, "ip", 1, 8, 20, False)]
    spans = spark.createDataFrame(rows, "row long, kind string, kind_no int, start long, end long, base boolean")
    got = sorted((r.row, r.start, r.end, r.kind) for r in pii._clear_of_kept(spans).collect())
    assert got == [(1, 0, 10, "phone"), (1, 18, 30, "phone"), (1, 40, 44, "ip"), (2, 8, 20, "ip")]
