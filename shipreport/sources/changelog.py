"""The change log of a document sorting run."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipreport.sources.contracts import rename
from shipreport.sources.schemas import SCHEMAS

# Column headings of the log.
HEADINGS = {
    "house_no": "HAWB No",
    "status": "Status",
    "file_name": "PDF Name",
    "old_type": "Old Type",
    "new_type": "New Type",
}


def change_log(changes: DataFrame) -> DataFrame:
    """Changes under the log's headings."""
    return rename(changes, HEADINGS)


# The column that tells runs apart, and the status of the row that every run writes, so
# that a run without changes is a run as well.
RUN, RUN_STATUS = "run", "(run)"


def write_changes(changes: DataFrame, path: str, file_format: str = "parquet", run: str | None = None) -> str:
    """Add the log of one run, as one job, and return the run's name.

    Runs lie side by side, and rows appear only when all tasks have committed; a run that
    fails leaves all former logs as they were. Names sort by time unless given.
    """
    run = run or f"{dt.datetime.now(dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    log = change_log(changes)
    status = HEADINGS["status"]
    mark = log.sparkSession.createDataFrame([(RUN_STATUS,)], "status string").select(*[
        (F.col("status") if c == status else F.lit(None).cast(log.schema[c].dataType)).alias(c) for c in log.columns])
    writer = log.unionByName(mark).withColumn(RUN, F.lit(run)).write.mode("append").partitionBy(RUN)
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.format(file_format).save(path)
    return run


def read_changes(spark: SparkSession, path: str, file_format: str = "parquet", run: str | None = None) -> DataFrame:
    """The log of a run, the latest if none is named."""
    reader = spark.read
    if file_format == "csv":
        reader = reader.option("header", True)
    runs = reader.format(file_format).load(path)
    if run is None:
        run = runs.where(F.col(f"`{HEADINGS['status']}`") == RUN_STATUS).agg(F.max(RUN)).first()[0]
    log = runs.where((F.col(RUN) == run) & (F.col(f"`{HEADINGS['status']}`") != RUN_STATUS)).drop(RUN)
    back = {heading: column for column, heading in HEADINGS.items()}
    return rename(log, back).to(SCHEMAS["change_log"])
