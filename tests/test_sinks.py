"""Sinks, read-back verification, DDL and catalog listing."""
from shopscope.sources import sinks


def test_output_verification_csv(star, tmp_path):
    rows = sinks.output_verification(star.tables(), str(tmp_path / "csv"), "csv").collect()
    assert [r.table_name for r in rows] == sinks.LOAD_ORDER
    for r in rows:
        assert r.written and r.has_bytes and r.schema_equal and r.content_equal and r.rows_expected == r.rows_read > 0


def test_verification_sees_damage(spark, tmp_path):
    from datetime import date

    schema = "id bigint, name string, day date"
    df = spark.createDataFrame([(1, "a", date(2024, 1, 1)), (2, None, None)], schema)

    def check(path, fmt):
        r = sinks.verify_written(df, str(tmp_path / path), fmt, "t").first()
        return r.written, r.has_bytes, r.schema_equal, r.content_equal

    for fmt, write in (("csv", sinks.write_csv), ("parquet", sinks.write_parquet)):
        write(df, str(tmp_path / f"good_{fmt}"))
        assert check(f"good_{fmt}", fmt) == (True, True, True, True)
        write(df.replace("a", "b"), str(tmp_path / f"text_{fmt}"))
        assert check(f"text_{fmt}", fmt) == (True, True, True, False)
        write(df.limit(1), str(tmp_path / f"short_{fmt}"))
        assert check(f"short_{fmt}", fmt) == (True, True, True, False)
        write(df.withColumnRenamed("name", "other"), str(tmp_path / f"named_{fmt}"))
        assert check(f"named_{fmt}", fmt) == (True, True, False, False)
        write(df.selectExpr("'x' AS id", "name", "day"), str(tmp_path / f"typed_{fmt}"))
        assert check(f"typed_{fmt}", fmt)[2:] == (False, False)
        assert check(f"none_{fmt}", fmt) == (False, False, False, False)


def test_database_load_runs_parents_first(star):
    """No database may be started here: the writer is recorded instead."""
    calls = []
    sinks.load_star_jdbc(star.tables(), "jdbc:x:y", write=lambda df, url, table, **o: calls.append((table, df.columns, o)), batchsize=500)
    assert [c[0] for c in calls] == sinks.LOAD_ORDER and calls[0][2] == {"batchsize": 500}
    assert calls[3][1][0] == "sale_id"


def test_ddl_catalog_and_load(spark, star, tmp_path):
    db = "shopscope_test_db"
    names = sinks.create_star_tables(spark, db, str(tmp_path / "tables"))
    assert names == sorted(sinks.LOAD_ORDER)
    sinks.load_star(star.tables(), db)
    sinks.load_star(star.tables(), db)  # re-running a load is idempotent
    for t in sinks.LOAD_ORDER:
        assert spark.table(f"{db}.{t}").count() == star.tables()[t].count()
    ddl = sinks.star_ddl()
    assert len(ddl) == 5 and all(s.startswith("CREATE TABLE IF NOT EXISTS") for s in ddl)
    assert "sale_id BIGINT NOT NULL" in ddl[3]


def test_read_two_yearly_csv_files(spark, star, tmp_path):
    """S-01/S-02: two yearly extracts read as one DataFrame with the declared schema."""
    from pyspark.sql import functions as F

    from shopscope.sources.files import read_sales_files
    raw = star.raw
    early, late = str(tmp_path / "y1"), str(tmp_path / "y2")
    sinks.write_csv(raw.where(F.year("invoice_ts") < 1998), early)
    sinks.write_csv(raw.where(F.year("invoice_ts") >= 1998), late)
    back = read_sales_files(spark, [early, late], fmt="csv")
    assert back.schema == raw.schema
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0


def test_float_customer_ids(spark, tmp_path):
    """P-04: ids written as floats ('12346.0', empty for guests) read as BIGINT."""
    from shopscope.sources.files import read_sales_files
    path = tmp_path / "raw.csv"
    path.write_text("invoice,stock_code,description,quantity,invoice_ts,price,customer_id,country\n"
                    "1,A,x,2,2024-01-01T10:00:00,1.5000,12346.0,N\n"
                    "C2,B,,-1,2024-01-02T11:30:00,2.0000,,N\n")
    df = read_sales_files(spark, str(path), fmt="csv", float_ids=True)
    assert [r.customer_id for r in df.orderBy("invoice").collect()] == [12346, None]
    assert dict(df.dtypes)["customer_id"] == "bigint"


def test_writes_observe_their_rows(spark, star, tmp_path):
    """The writing job's figures equal a second pass over the rows; nothing but keys is read for the checks."""
    from shopscope import schemas
    from shopscope.operators import integrity
    for name, df in star.tables().items():
        if name == "clean_sales":
            continue
        stored = spark.read.parquet(f"{star.location}/{name}")
        m = star.metrics[name]
        again = stored.agg(*sinks.checks(stored, schemas.PRIMARY_KEYS[name], schemas.NOT_NULL[name])).first()
        assert (m["n"], m["h"], m["null_keys"], m["not_null_violations"]) == tuple(again)
    assert integrity.pk_violations(star.tables(), star.metrics).collect() == integrity.pk_violations(star.tables()).collect()
    assert integrity.load_row_counts(star.tables(), star.metrics).collect() == integrity.load_row_counts(star.tables()).collect()
    bad = spark.createDataFrame([(1, None), (None, "x"), (None, None)], "k bigint, v string")
    df, seen = sinks.observed(bad, ["k"], ["k", "v"])
    df.write.parquet(str(tmp_path / "bad"))
    assert (seen.get["n"], seen.get["null_keys"], seen.get["not_null_violations"]) == (3, 2, 4)
    try:
        integrity.load_row_counts({**star.tables(), "dim_date": star.dim_date.limit(3)}, star.metrics).collect()
        raise AssertionError("a lost row passes")
    except Exception as e:
        assert "rows written, stored: 3" in str(e)
