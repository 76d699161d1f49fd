"""The reports on random edge-case tables, against SQL written branch by branch.

Run with small tables as they are, with sizes even and tables thinned by broadcast
keys, and with every join shuffled and its hot keys salted.
"""

import datetime as dt

import duckdb
import pytest

from compare import differences, oracle_bag, spark_bag
from fixtures import at, parquet_tables, random_rows, tables
from shipreport.plans.invoices import COLUMNS, Billing, invoice_rows
from shipreport.plans.weight import weight_rows
from shipreport.workload import oracles
from shipreport.workload.queries import BILLING

START, END = at("2024-03-04"), at("2024-03-15")


def in_duckdb(frames, tmp_path):
    con = duckdb.connect()
    for name in frames:
        con.execute(f"CREATE TABLE t_{name} AS SELECT * FROM '{tmp_path / name}.parquet'")

    def stacked(kind, modes, key):
        con.execute(f"CREATE TABLE {kind} AS " + " UNION ALL BY NAME ".join(
            f"SELECT '{m}' AS mode, * FROM t_{key}_{m}" for m in modes))

    stacked("house_bill", ("AE", "AI", "3A"), "house")
    stacked("booking", ("AE", "AI"), "booking")
    stacked("master", ("AE", "AI"), "master")
    con.execute("ALTER TABLE house_bill RENAME id TO source_id")
    con.execute("ALTER TABLE master RENAME id TO master_id")
    for name in ("invoice_header", "invoice_line", "city", "milestone"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM t_{name}")
    con.execute("CREATE VIEW client AS SELECT * FROM t_customer")
    con.execute("CREATE TABLE listed AS SELECT unnest([1, 2]) AS c_custkey")
    con.execute("CREATE VIEW nation AS SELECT id AS n_nationkey, name AS n_name FROM t_country")
    return con


def dated(sql):
    return (sql.replace("TIMESTAMP '1996-01-01'", f"TIMESTAMP '{START}'")
            .replace("TIMESTAMP '1999-12-31'", f"TIMESTAMP '{END}'"))


def check_weight(spark, tmp_path, seed, listed):
    frames = parquet_tables(spark, random_rows(seed, size=400), tmp_path)
    con = in_duckdb(frames, tmp_path)
    sql = f"WITH cache AS ({oracles.ROLES['cache']})" + " UNION ".join(
        oracles.weight_branch(m) for m in ("AE", "AI", "3A"))
    want = oracle_bag(con, dated(sql))
    got = spark_bag(weight_rows(frames, START, END, listed, "ACME"))
    assert sum(want[1].values()) > 20
    assert not differences(got, want)


def check_invoices(spark, tmp_path, seed, ranged):
    frames = parquet_tables(spark, random_rows(seed, size=400), tmp_path)
    con = in_duckdb(frames, tmp_path)
    sql = oracles.invoice_branches(False)
    if ranged:
        sql = sql.rstrip() + f" AND inv.invoice_date BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'"
    sql = (sql.replace("'BUILDING'", "'CODE1'").replace("'MACHINERY'", "'CODE2'")
           .replace("'A' || CAST(oa.n_nationkey AS VARCHAR)", "'AP' || CAST(oa.n_nationkey AS VARCHAR)")
           .replace("'A' || CAST(da.n_nationkey AS VARCHAR)", "'AP' || CAST(da.n_nationkey AS VARCHAR)"))
    want = oracle_bag(con, sql)
    billing = Billing("code1 ", "CODE2", BILLING.texts)
    dates = (START, END) if ranged else ()
    df = invoice_rows(frames, billing, *dates)
    assert df.columns == list(COLUMNS)
    assert sum(want[1].values()) > 10
    assert not differences(spark_bag(df), want)


def test_weight_broadcast(spark, tmp_path):
    check_weight(spark, tmp_path, 1, [1, 2])


def test_weight_shuffled(spark, tmp_path, shuffled):
    check_weight(spark, tmp_path, 3, spark.createDataFrame([(1,), (2,)], "c_custkey bigint"))


def test_weight_even(spark, tmp_path, even):
    check_weight(spark, tmp_path, 7, [1, 2])


def test_invoices_even(spark, tmp_path, even):
    check_invoices(spark, tmp_path, 8, ranged=True)


def test_invoices_broadcast(spark, tmp_path):
    check_invoices(spark, tmp_path, 5, ranged=False)


def test_invoices_shuffled(spark, tmp_path, shuffled):
    check_invoices(spark, tmp_path, 6, ranged=True)


def test_half_a_range_is_refused(spark):
    with pytest.raises(ValueError):
        invoice_rows(tables(spark, {}), Billing("A", "B"), start=dt.datetime(2024, 1, 1))
