import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent
sys.path[:0] = [str(ROOT.parent), str(ROOT)]


@pytest.fixture(scope="session")
def spark():
    from shipreport.session import build_session

    session = build_session("local[8]", shuffle_partitions=8, **{
        "spark.ui.enabled": "false", "spark.driver.memory": "6g", "spark.sql.session.timeZone": "UTC"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def shuffled(spark, monkeypatch):
    """No side is small enough to broadcast and every key may count as hot."""
    from shipreport.operators import joins

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(joins, "HOT_ROWS", 0)
    yield joins
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def even(spark):
    """No side is small enough to broadcast, and no key is hot."""
    from shipreport.operators import joins

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield joins
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
