"""What the physical plans look like."""

import re

import pytest
from pyspark.sql import functions as F

from shipreport.workload.queries import QUERIES
from fixtures import at, money, tables
from shipreport.plans.weight import weight_rows

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    before = spark.conf.get("spark.sql.maxPlanStringLength")
    spark.conf.set("spark.sql.maxPlanStringLength", "10000000")
    yield {name: plan(query(spark, SF)) for name, query in QUERIES.items()}
    spark.conf.set("spark.sql.maxPlanStringLength", before)


def test_no_python_and_no_cross_join(plans):
    for name, text in plans.items():
        assert not re.search(r"EvalPython|InPandas|PythonUDF|InArrow", text), name
        assert not re.search(r"CartesianProduct|NestedLoopJoin", text), name


def test_nothing_is_gathered_in_one_task(plans):
    assert [n for n, text in plans.items() if "SinglePartition" in text] == []


def test_charges_are_one_aggregate_over_one_scan(plans):
    text = plans["charge_two_measures"]
    assert text.count("lineitem.parquet") == 1 and text.count("orders.parquet") == 1
    assert len(re.findall(r"\bHashAggregate", text)) == 2 and "SortAggregate" not in text


def test_cached_charges_never_pair_headers_with_lines(plans):
    assert plans["charge_sum_cached"].count("lineitem.parquet") == 1


def test_columns_and_filters_reach_the_scan(plans):
    assert re.search(r"PushedFilters: \[IsNotNull\(o_orderdate\), GreaterThanOrEqual\(o_orderdate,.*LessThanOrEqual",
                     plans["invoice_date_range"])
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plans["charge_bucket"]).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice"}
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz" in plans["time_text"]


def test_top1_window_is_limited_before_the_shuffle(plans):
    text = plans["top1_window"]
    assert text.index("WindowGroupLimit") < text.index("Exchange") < text.rindex("WindowGroupLimit")


def test_document_rules_run_once_and_after_the_join(plans):
    text = plans["doc_sort_report"]
    assert text.count("ACME INVOICE") == 1
    assert text.index("ACME INVOICE") < text.index("BroadcastHashJoin")


def test_change_counts_run_the_rules_once_over_one_scan(plans):
    text = plans["change_counts"]
    assert text.count("documents.parquet") == 1 and text.count("ACME INVOICE") == 1 and "Rollup" not in text


def test_texts_are_reduced_by_hash_before_they_are_sorted(plans):
    # The partial aggregate over all rows, which is the deepest one, is a hash aggregate.
    for name in ("latest_booking", "latest_eta", "latest_milestone", "milestone_any", "delivery_date",
                 "invoice_currency", "charge_sum_cached"):
        deepest = re.findall(r"(\w+Aggregate)\(", plans[name])[-1]
        assert deepest == "HashAggregate", name


def shuffled_plan(spark, name):
    return plan(QUERIES[name](spark, SF))


@pytest.mark.parametrize("name", ["weight_report", "invoice_report_range", "invoice_report_all"])
def test_the_selective_join_of_a_report_lies_below_its_lookups(spark, even, name):
    text = shuffled_plan(spark, name)
    # Invoices and bills meet inside what is kept; everything else is joined to that.
    above, _, kept = text.partition("InMemoryRelation")
    assert kept and "orders.parquet" in kept and "InMemoryTableScan" in above


def weight_tables(spark):
    header = dict(station="S", temp_seq=1, id_type="H", product_line="AMS", mode="AE", customer_id=1,
                  invoice_date=at("2024-03-05"), amount=money(100), lot="L")
    third = header | dict(mode="3A", product_line="3PS")
    house = dict(station="S", status="OPEN", customer_id=1, pcs=1, pcs_uom="PLT", sp_unit=0, house_no="H")
    line = dict(station="S", temp_seq=1, charge_id=13, currency="SGD")
    return tables(spark, {
        "invoice_header": [
            header | dict(source_id=1, invoice_no="I1"), header | dict(source_id=1, invoice_no="I1"),
            header | dict(source_id=1, invoice_no="I2", temp_seq=2),
            third | dict(source_id=3, invoice_no="I3", customer_id=99),
            third | dict(source_id=3, invoice_no="I4"),
            header | dict(source_id=1, invoice_no="I5", customer_id=99),
            header | dict(source_id=8, invoice_no="I6")],
        "invoice_line": [
            line | dict(invoice_no="I1", amount=money(10)), line | dict(invoice_no="i1 ", amount=money(1)),
            line | dict(invoice_no="I2", amount=money(20)), line | dict(invoice_no="I3", amount=money(30)),
            line | dict(invoice_no="I4", amount=money(40)), line | dict(invoice_no="I5", amount=money(50))],
        "house_AE": [house | dict(id=1, master_id=5), house | dict(id=1, master_id=5),
                     house | dict(id=8, status="void ")],
        "house_3A": [house | dict(id=3, master_no="M3", flight="SQ1")],
        "master_AE": [dict(id=5, station="S", master_no="M5"), dict(id=5, station="T", master_no="no")],
    })


def test_weight_report_row_rules(spark):
    report = weight_rows(weight_tables(spark), at("2024-03-01"), at("2024-03-31"), [1], "ACME")
    rows = report.select("`Invoice no.`", "Mode", "`Master Inv No.`", "Freight", "Currency", "Airline").collect()
    # Two equal headers give one row with doubled sums; a line of another sequence number
    # does not count; a third-party invoice whose own customer is not listed has no sums.
    assert sorted(map(tuple, rows)) == [
        ("I1", "AE", "M5", money(22), "SGD", None), ("I2", "AE", "M5", None, None, None),
        ("I3", "3A", "M3", None, None, "SQ"), ("I4", "3A", "M3", money(40), "SGD", "SQ")]
    exact = weight_rows(weight_tables(spark), at("2024-03-01"), at("2024-03-31"), [1], "ACME", ignore_case=False)
    found = {r[0]: r[1] for r in exact.select("`Invoice no.`", "Freight").collect()}
    assert found["I1"] == money(20) and found["I6"] == None  # noqa: E711


def test_shuffled_joins_leave_no_salt_columns(spark, shuffled):
    report = weight_rows(weight_tables(spark), at("2024-03-01"), at("2024-03-31"), [1], "ACME")
    assert report.count() == 4 and not [c for c in report.columns if c.startswith("_")]
    assert report.where(F.col("Mode") == "AE").count() == 2


def test_the_kept_join_of_the_invoice_report_holds_what_the_report_reads(spark, monkeypatch):
    from shipreport.plans import invoices

    kept, plain = [], invoices.shared
    monkeypatch.setattr(invoices, "shared", lambda df: kept.append(df.columns) or plain(df))
    QUERIES["invoice_report_all"](spark, SF)
    assert set(kept[0]) == {*invoices.SHIPMENT, *invoices.BILL, "invoice_key", "invoice_no", "invoice_date", "amount"} - {"customer_id"}
