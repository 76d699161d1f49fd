"""Who lets go of an intermediate, and when."""

import gc

import pytest

from shipreport.sources.folders import shared_folder
from shipreport.sources.reuse import holding, owned, shared, written


def cached(df) -> bool:
    return "InMemoryTableScan" in df._jdf.queryExecution().executedPlan().toString()


def report(spark):
    kept = shared(spark.range(100).selectExpr("id", "id % 7 AS k"))
    return holding(kept.groupBy("k").count(), kept)


def test_owned_frames_outlive_the_report(spark):
    with owned() as kept:
        out = report(spark)
        derived = out.where("k > 2")
        del out
        gc.collect()
        assert len(kept) == 1 and cached(derived.select("count")) and derived.count() == 4
        assert kept[0].storageLevel.useMemory
    assert not kept[0].storageLevel.useMemory
    assert derived.count() == 4  # still right, computed again


def test_owners_nest_and_release_after_errors(spark):
    with pytest.raises(ZeroDivisionError):
        with owned() as outer:
            a = shared(spark.range(5))
            with owned() as inner:
                shared(spark.range(6))
            assert len(inner) == len(outer) == 1 and a.storageLevel.useMemory and not inner[0].storageLevel.useMemory
            raise ZeroDivisionError
    assert not a.storageLevel.useMemory


def test_without_an_owner_the_report_holds_it(spark):
    out = report(spark)
    gc.collect()
    assert cached(out.select("k")) and out.count() == 7


def test_written_has_a_name_and_goes(spark):
    with written(spark.range(10), "steps") as df:
        assert df.where("id > 3").count() == spark.table("steps").where("id > 3").count() == 6
        place = df.inputFiles()[0]
        assert "steps-" in place
    assert not spark.catalog.tableExists("steps")
    with pytest.raises(Exception):
        spark.read.parquet(place).count()


def test_a_cluster_must_name_a_shared_folder():
    class Session:
        class conf:
            @staticmethod
            def get(name, default):
                return default

        class sparkContext:
            master = "yarn"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session, "x")
    Session.sparkContext.master = "local[2]"
    assert "/x-" in shared_folder(Session, "x")
