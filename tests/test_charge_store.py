"""Stored charge sums: only the months that lines arrived in are replaced, and all equal a fresh sum."""

import datetime as dt
import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from compare import bag
from shipreport.operators.charges import charge_pivot
from shipreport.sources.charge_store import UNDATED, ChargeStore
from test_plans import plan

KEYS = ("invoice_no", "station")
COLUMNS = {"freight": ("amount", [13]), "Fuel, etc.": ("amount", [14, 15])}


def headers(spark):
    return spark.createDataFrame(
        [("A", "S", dt.datetime(2024, 1, 5)), ("A", "S", dt.datetime(2024, 2, 5)), ("B", "S", dt.datetime(2024, 2, 1)),
         ("C", "S", dt.datetime(2024, 3, 31, 23)), ("D", "S", None), ("E", "S", dt.datetime(2024, 3, 1)), (None, "S", dt.datetime(2024, 1, 1))],
        "invoice_no string, station string, invoice_date timestamp_ntz")


def lines(spark, rows):
    return spark.createDataFrame([(k, "S", c, None if a is None else a) for k, c, a in rows],
                                 "invoice_no string, station string, charge_id int, amount decimal(18,2)")


OLD = [("A", 13, 1), ("A", 14, 2), ("B", 13, 4), ("C", 15, 8), ("D", 13, 16), ("X", 13, 32), (None, 13, 64), ("A", 99, 5)]


def dec(rows):
    from decimal import Decimal

    return [(k, c, None if a is None else Decimal(a)) for k, c, a in rows]


def want(spark, all_lines):
    keys = headers(spark).select(*KEYS).distinct()
    df = charge_pivot(all_lines, KEYS, COLUMNS).join(keys, list(KEYS), "left_semi")
    return bag(df.columns, df.collect())


def got(store):
    df = store.read()
    return bag(df.columns, df.collect())


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/month=*/*.parquet")}


@pytest.fixture
def store(spark, tmp_path):
    made = ChargeStore(spark, str(tmp_path / "sums"), KEYS, COLUMNS)
    made.refresh(headers(spark), lines(spark, dec(OLD)))
    return made


def test_only_touched_months_are_replaced(spark, store):
    assert got(store) == want(spark, lines(spark, dec(OLD)))
    before = files(store.path)
    assert {f.split("month=")[1].split("/")[0] for f in before} == {"2024-01", "2024-02", "2024-03", UNDATED}
    new = [("B", 13, 100), ("D", 14, 200), ("X", 14, 1), ("B", 14, None)]
    months = store.touched(headers(spark), lines(spark, dec(new)))
    assert months == ["2024-02", UNDATED]
    every = lines(spark, dec(OLD + new))
    store.refresh(headers(spark), every, months)
    assert got(store) == want(spark, every)
    after = files(store.path)
    same = {f for f in before if after.get(f) == before[f]}
    assert {f.split("month=")[1].split("/")[0] for f in same} == {"2024-01", "2024-03"}
    store.refresh(headers(spark), every, months)  # once more: the same
    assert got(store) == want(spark, every)


def test_a_month_that_lost_its_lines_is_emptied(spark, store):
    left = lines(spark, dec([r for r in OLD if r[0] != "C"]))
    store.refresh(headers(spark), left, ["2024-03"])
    assert got(store) == want(spark, left)
    store.refresh(headers(spark), left, [])
    assert got(store) == want(spark, left)


def test_a_refresh_that_fails_leaves_the_sums(spark, store):
    before = got(store)
    broken = lines(spark, dec(OLD)).withColumn("amount", F.raise_error(F.lit("broken")).cast("decimal(18,2)"))
    with pytest.raises(Exception, match="broken"):
        store.refresh(headers(spark), broken, ["2024-01", "2024-02"])
    assert got(store) == before


def test_months_of_a_report_are_pruned(spark, store):
    df = store.read(["2024-02"])
    assert {r["invoice_no"] for r in df.collect()} == {"B"}
    assert re.search(r"PartitionFilters: \[[^]]*month#\d+ = 2024-02", plan(df))


def test_sums_of_one_row_a_key_are_not_counted_for_hot_keys(spark, store, even, monkeypatch):
    from shipreport.operators import joins

    probed = []
    monkeypatch.setattr(joins.Probe, "_search", lambda self, lists: probed.append(self.df.columns) or self._hot.update({k: [] for k in lists}))
    monkeypatch.setattr(joins, "split_by_spark", lambda df: False)
    every = lines(spark, dec(OLD))
    store.refresh(headers(spark), every, store.touched(headers(spark), every))
    assert got(store) == want(spark, every) and probed == [every.columns]
