"""Loads that are repeated, killed, dirty or incremental."""
import pytest
from pyspark.sql import functions as F

from shopscope.operators import clv, cohorts, reports, revenue, rfm
from shopscope.plans.increments import MonthlyReports
from shopscope.sources import sinks
from shopscope.sources.files import TooManyRejects, load_sales_files, read_sales_files
from shopscope.sources.ledger import Ledger

HEAD = "invoice,stock_code,description,quantity,invoice_ts,price,customer_id,country\n"
GOOD = ['1,A,"x, y",2,2024-01-01T10:00:00,1.5000,12346,N\n', "C2,B,,-1,2024-01-02T11:30:00,2.0000,,N\n", "3,C,z,1,2024-01-03T00:00:00,0.5000,7,M\n"]
BAD = [("4,A,x,many,2024-01-01T10:00:00,1.5,1,N\n", "value", ["quantity"]), ("5,A,x,1\n", "columns", []),
       ("6,A,x,1,yesterday,cheap,1,N\n", "value", ["invoice_ts", "price"]), ("7,A,x,1,2024-01-01T10:00:00,1.5,1,N,more\n", "columns", [])]


def _files(tmp_path):
    (tmp_path / "a.csv").write_text(HEAD + GOOD[0] + BAD[0][0] + BAD[1][0] + GOOD[1])
    (tmp_path / "b.csv").write_text(HEAD + BAD[2][0] + GOOD[2] + BAD[3][0])
    (tmp_path / "c.csv").write_text(HEAD)
    (tmp_path / "good.csv").write_text(HEAD + "".join(GOOD))
    return [str(tmp_path / f"{n}.csv") for n in "abc"]


def test_bad_lines_are_set_aside(spark, tmp_path):
    files = _files(tmp_path)
    got = load_sales_files(spark, files, str(tmp_path / "out"))
    good = read_sales_files(spark, str(tmp_path / "good.csv"), fmt="csv")
    assert got.rows.schema == good.schema
    assert sorted(got.rows.collect(), key=str) == sorted(good.collect(), key=str)
    rejects = {r.record: (r.reason, r.bad_columns, r.source_file[-5:]) for r in got.rejects.collect()}
    assert {k: v[0] for k, v in rejects.items()} == {line.strip(): reason for line, reason, _ in BAD}
    assert all(rejects[line.strip()][1] == columns for line, reason, columns in BAD if reason == "value")
    assert [rejects[line.strip()][2] for line, _, _ in BAD] == ["a.csv", "a.csv", "b.csv", "b.csv"]
    assert {(r.source_file[-5:], r.lines_read, r.lines_kept, r.lines_rejected) for r in got.audit.collect()} == {("a.csv", 4, 2, 2), ("b.csv", 3, 1, 2)}
    # a count alone reads no column; the bad lines stay bad
    assert got.rows.count() == 3 and got.rows.select("country").where("country = 'N'").count() == 2


def test_too_many_rejects_and_clean_files(spark, tmp_path):
    files = _files(tmp_path)
    with pytest.raises(TooManyRejects, match="4 of 7"):
        load_sales_files(spark, files, str(tmp_path / "out"), most_rejected=0.5)
    clean = load_sales_files(spark, str(tmp_path / "good.csv"), str(tmp_path / "out2"), most_rejected=0.0)
    assert clean.rows.count() == 3 and clean.rejects.count() == 0
    with pytest.raises(Exception):
        read_sales_files(spark, files, fmt="csv").collect()


def test_float_ids_among_bad_lines(spark, tmp_path):
    (tmp_path / "f.csv").write_text(HEAD + "1,A,x,2,2024-01-01T10:00:00,1.5000,12346.0,N\n2,A,x,2,2024-01-01T10:00:00,1.5000,guest,N\n")
    got = load_sales_files(spark, str(tmp_path / "f.csv"), str(tmp_path / "out"), float_ids=True)
    assert [r.customer_id for r in got.rows.collect()] == [12346] and dict(got.rows.dtypes)["customer_id"] == "bigint"
    assert [r.bad_columns for r in got.rejects.collect()] == [["customer_id"]]


def _frames(spark, n):
    return {"parents": spark.range(n).withColumnRenamed("id", "p"), "children": spark.range(3 * n).selectExpr("id", "id % 7 as p")}


def test_a_killed_and_repeated_load_is_one_load(spark, tmp_path):
    book = Ledger(spark, str(tmp_path / "tables"))
    with pytest.raises(LookupError):
        book.read("parents")
    book.load("2024-01", _frames(spark, 10))
    killed = {**_frames(spark, 5), "children": spark.range(9).select(F.raise_error(F.lit("killed")).cast("bigint").alias("id"), F.lit(1).cast("bigint").alias("p"))}
    with pytest.raises(Exception):
        book.load("2024-02", killed)  # the parents are written, the children are not
    assert book.read("parents").count() == 10 and book.loads() == ["2024-01"]
    for _ in range(2):  # run again, and once more by mistake
        book.load("2024-02", _frames(spark, 5))
    assert book.read("parents").count() == 15 and book.read("children").count() == 45 and book.loads() == ["2024-01", "2024-02"]
    assert book.read("parents", lambda load: load == "2024-02").count() == 5
    gone = book.vacuum()  # the killed load's parents, the repeated load's first tables
    assert len(gone) >= 3 and book.read("parents").count() == 15 and book.read("children").count() == 45
    assert book.vacuum() == []


def test_an_unfinished_entry_says_nothing(spark, tmp_path):
    book = Ledger(spark, str(tmp_path / "tables"))
    book.load("a", _frames(spark, 2))
    (tmp_path / "tables" / "_ledger" / "0000000002.json").write_text('{"loads": {"b"')
    assert book.loads() == ["a"]
    book.load("c", _frames(spark, 3))
    assert book.loads() == ["a", "c"] and book.read("parents").count() == 5


def test_two_loads_that_publish_at_once_both_stay(spark, tmp_path):
    book, other = Ledger(spark, str(tmp_path / "tables")), Ledger(spark, str(tmp_path / "tables"))
    newest, raced = book._newest, []

    def late():
        found = newest()
        if not raced:  # the other load publishes between reading and writing the entry
            raced.append(1)
            other.load("second", _frames(spark, 1))
        return found

    book._newest = late
    book.load("first", _frames(spark, 2))
    assert Ledger(spark, book.root).loads() == ["first", "second"]


def test_star_through_the_ledger(spark, star, tmp_path):
    for _ in range(2):
        sinks.load_star_ledger(star.tables(), Ledger(spark, str(tmp_path / "star")), "all")
    for name in sinks.LOAD_ORDER:
        back = Ledger(spark, str(tmp_path / "star")).read(name)
        assert back.count() == star.tables()[name].count()


def _same(a, b):
    assert a.columns == b.columns and sorted(a.collect(), key=str) == sorted(b.collect(), key=str)


def test_months_added_one_by_one_equal_a_rebuild(spark, star, tmp_path):
    raw = star.raw
    month = F.year("invoice_ts") * 100 + F.month("invoice_ts")
    kept = MonthlyReports(spark, str(tmp_path / "months"))
    kept.add(raw.where(month <= 200012))
    for m in (200101, 200102):
        assert kept.add(raw.where(month == m)) == [m]
    part = raw.where(month <= 200102)

    def check():
        from shopscope.operators.cleaning import clean_sales
        clean = clean_sales(part)
        _same(kept.rfm_base(), rfm.rfm_base(clean))
        _same(kept.customer_clv(), clv.customer_clv(clean))
        _same(kept.monthly_summary(), revenue.monthly_summary(clean))
        _same(cohorts.cohort_retention_matrix(None, bitsets=kept.bitsets()), cohorts.cohort_retention_matrix(clean))
        _same(reports.month1_retention(None, bitsets=kept.bitsets()), reports.month1_retention(clean.withColumn("date_id", F.to_date("invoice_ts"))))

    check()
    kept.add(raw.where(month == 200102))  # the same month again
    kept.add(raw.where((month == 200101) & (F.col("country") == "nowhere")), months=[200101])  # a month corrected to nothing
    assert 200101 not in {r.sale_month for r in kept.states().select("sale_month").distinct().collect()}
    kept.add(raw.where(month == 200101))
    kept.ledger.vacuum()
    check()
    some = kept.monthly_summary(200101, 200102).collect()
    assert sorted(r.year_month for r in some) == ["2001-01", "2001-02"]
