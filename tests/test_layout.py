"""Laid-out tables: no shuffle in their joins, only the months of a range are read, hot keys lie apart."""

import datetime as dt
import glob
import re

import pytest
from pyspark.sql import functions as F

from compare import bag
from shipreport.operators import joins
from shipreport.sources import layout
from shipreport.sources.layout import co_located, lay_out
from shipreport.workload.queries import QUERIES
from test_plans import SF, plan

KEYS = ["invoice_no", "station"]


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def rows(df):
    return bag(df.columns, df.collect())


def headers(spark, n=200):
    day = dt.datetime(2024, 1, 1)
    data = [(None if i % 17 == 0 else f"I{i // 2}", "S1" if i % 3 else "s 2", i, None if i % 19 == 0 else day + dt.timedelta(hours=13 * i))
            for i in range(n)]
    return spark.createDataFrame(data, "invoice_no string, station string, id int, date timestamp_ntz")


def lines(spark, n=300, hot="I3"):
    data = [(hot if i % 3 == 0 else f"I{i % 120}", "S1" if i % 2 else "s 2", float(i), "x") for i in range(n)]
    return spark.createDataFrame(data, "invoice_no string, station string, amount double, note string")


@pytest.fixture
def laid(spark, tmp_path):
    made = []

    def make(df, name, date=None, buckets=4):
        made.append(lay_out(df, f"t_{name}_{tmp_path.name.replace('-', '_')}", str(tmp_path), KEYS, buckets, date))
        return made[-1]

    yield make
    for table in made:
        table.drop()


@pytest.mark.parametrize("how", ["left", "inner"])
def test_no_shuffle_and_same_rows(spark, no_broadcast, laid, how):
    a, b = headers(spark), lines(spark)
    left, right = laid(a, "h", "date"), laid(b, "l")
    out = co_located(left, right, how)
    assert "Exchange" not in plan(out) and not left.hot + right.hot
    assert rows(out) == rows(a.join(b, KEYS, how).select(out.columns))
    assert rows(left.rows()) == rows(a) and rows(right.rows()) == rows(b)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_keys_lie_apart(spark, no_broadcast, laid, monkeypatch, how):
    monkeypatch.setattr(joins, "HOT_ROWS", 10)
    a, b = headers(spark), lines(spark)
    left, right = laid(a, "h", "date"), laid(b, "l")
    assert right.hot and not right.bucketed().where("invoice_no = 'I3'").count() and right.apart().where("invoice_no = 'I3'").count()
    out = co_located(left, right, how)
    assert rows(out) == rows(a.join(b, KEYS, how).select(out.columns))
    assert rows(right.rows()) == rows(b)
    # Two hot sides, of different keys.
    assert rows(co_located(right, laid(lines(spark, hot="I5").withColumnRenamed("amount", "b").drop("note"), "m"), how)) == rows(
        b.join(lines(spark, hot="I5").withColumnRenamed("amount", "b").drop("note"), KEYS, how))


def test_range_reads_its_months_only(spark, laid):
    a = headers(spark)
    table = laid(a, "h", "date")
    for start, end in ((dt.datetime(2024, 1, 31), dt.datetime(2024, 3, 1, 12)), (dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 1))):
        out = table.between("date", start, end)
        assert rows(out) == rows(a.where(F.col("date").between(start, end)))
        assert re.search(rf"PartitionFilters: \[[^]]*part_month.*{start:%Y-%m}", plan(out))
        months = {re.search(r"part_month=([^/]*)", f).group(1) for f in out.inputFiles()}
        assert months <= {"2024-01", "2024-02", "2024-03"}


def test_one_file_a_bucket_and_folder(spark, laid, tmp_path):
    table = laid(headers(spark), "h", "date")
    folders = glob.glob(f"{tmp_path}/{table.name}/part_station=*/part_month=*")
    assert folders and all(1 <= len(glob.glob(f"{f}/*.parquet")) <= 4 for f in folders)


def test_queries(spark, no_broadcast):
    assert "Exchange" not in plan(QUERIES["bucketed_header_lines"](spark, SF))
    assert "Exchange" not in plan(QUERIES["bucketed_house_bills"](spark, SF))
    assert re.search(r"PartitionFilters: \[[^]]*part_month", plan(QUERIES["partitioned_date_range"](spark, SF)))


def test_other_buckets_are_refused(spark, laid):
    with pytest.raises(ValueError):
        co_located(laid(headers(spark), "h"), laid(lines(spark), "l", buckets=2))


def test_empty_table(spark, laid):
    out = co_located(laid(headers(spark).limit(0), "h", "date"), laid(lines(spark), "l"))
    assert not out.count() and layout.STATION not in out.columns
