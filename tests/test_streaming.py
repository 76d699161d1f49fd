"""A sorting run that breaks goes on, and each change is in the log once."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from compare import bag
from shipreport.plans.sorting import doc_sort_report
from shipreport.streaming.sorting import document_stream, read_sorted, sort_stream

DAY = dt.date(2024, 1, 24)


@pytest.fixture
def files(spark, tmp_path):
    """Ten files of four documents."""
    place = str(tmp_path / "documents")
    for n in range(10):
        rows = [(4 * n + i, f"H{(4 * n + i) % 15:06d}", f"f{i}.pdf", "Others", "TAX INVOICE" if i % 2 else "PACKING LIST") for i in range(4)]
        spark.createDataFrame(rows, "doc_id bigint, house_no string, file_name string, current_type string, text string").coalesce(
            1).write.mode("append").parquet(place)
    shipments = spark.createDataFrame([(f"H{i:06d}", dt.datetime(2024, 1, 14 + i)) for i in range(12)], "house_no string, etd timestamp_ntz")
    return place, shipments


def wanted(spark, place, shipments):
    df = doc_sort_report(shipments, spark.read.parquet(place), DAY, "Acme")
    return bag(df.columns, df.collect())


def got(spark, log, run="r"):
    df = read_sorted(spark, log, run)
    return bag(df.columns, df.collect())


def test_whole_run_and_new_documents(spark, files, tmp_path):
    place, shipments = files
    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")

    def run():
        sort_stream(document_stream(spark, place, 3), lambda df: df, shipments, DAY, "Acme", log, checkpoint, "r")

    run()
    first = wanted(spark, place, shipments)
    assert got(spark, log) == first and sum(first[1].values()) > 10
    run()  # nothing new: nothing changes
    assert got(spark, log) == first
    spark.read.parquet(place).where("doc_id < 3").withColumn("doc_id", F.col("doc_id") + 100).coalesce(1).write.mode("append").parquet(place)
    run()  # only the new file is sorted
    assert got(spark, log) == wanted(spark, place, shipments)


@pytest.mark.parametrize("after_write", [False, True])
def test_a_broken_run_goes_on(spark, files, tmp_path, monkeypatch, after_write):
    place, shipments = files
    log, checkpoint = str(tmp_path / "log"), str(tmp_path / "checkpoint")
    seen = []

    def prepare(df):
        seen.append({r[0] for r in df.select("doc_id").collect()})
        if len(seen) == 3 and not after_write:
            raise RuntimeError("broken midway")
        return df

    def run():
        sort_stream(document_stream(spark, place, 2), prepare, shipments, DAY, "Acme", log, checkpoint, "r")

    if after_write:  # the batch was written, but the run broke before it counted as done
        from shipreport.streaming import sorting

        real = sorting.change_log

        class Breaking:
            def __init__(self, df):
                self.write = self
                self.df = real(df)

            def mode(self, _):
                return self

            def parquet(self, path):
                self.df.write.mode("overwrite").parquet(path)
                if len(seen) == 3:
                    raise RuntimeError("broken midway")

        monkeypatch.setattr(sorting, "change_log", Breaking)
    with pytest.raises(Exception, match="broken midway"):
        run()
    monkeypatch.undo()
    done = got(spark, log)
    whole = wanted(spark, place, shipments)
    assert sum(done[1].values()) < sum(whole[1].values())
    run()
    assert got(spark, log) == whole
    assert seen[3] == seen[2]  # the broken batch again, the earlier ones not
    assert len(seen) == 6


def test_runs_lie_apart(spark, files, tmp_path):
    place, shipments = files
    log = str(tmp_path / "log")
    for run in ("a", "b"):
        sort_stream(document_stream(spark, place), lambda df: df, shipments, DAY, "Acme", log, str(tmp_path / run), run)
    assert got(spark, log, "a") == got(spark, log, "b") == wanted(spark, place, shipments)


def test_single_file_as_a_stream(spark):
    from test_plans import SF

    place = document_stream(spark, f"{SF}/documents.parquet")
    assert place.isStreaming and "doc_id" in place.columns
