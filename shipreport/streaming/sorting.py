"""Document sorting as a stream that a crash does not set back.

Documents are read as a file stream with a checkpoint. Each micro-batch writes its changes under
the run's name and its own number, in place of whatever an earlier attempt left there, and only
then counts as done. A run that breaks goes on at the batch it broke in, and each change is in
the log once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipreport.operators.documents import CONTENT_RULES, Rules
from shipreport.plans.sorting import doc_sort_report
from shipreport.sources.changelog import HEADINGS, change_log
from shipreport.sources.contracts import rename
from shipreport.sources.schemas import SCHEMAS

RUN, BATCH = "run", "batch"


def document_stream(spark: SparkSession, path: str, files_at_once: int = 1000, file_format: str = "parquet") -> DataFrame:
    """New document files as a stream, so many in each batch. Their schema is that of the files now there."""
    schema = spark.read.format(file_format).load(path).schema
    # A file stream takes a plain path for a folder; as a pattern it may be a single file as well.
    if not set("*?[{") & set(path):
        path = f"{path[:-1]}[{path[-1]}]"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).format(file_format).load(path)


def sort_stream(stream: DataFrame, prepare: Callable[[DataFrame], DataFrame], shipments: DataFrame, day: dt.date, forwarder: str,
                path: str, checkpoint: str, run: str, rules: Rules = CONTENT_RULES) -> None:
    """Sort all documents that are there and not yet sorted in this run, batch by batch, and return.

    ``prepare`` makes canonical documents of a batch. ``checkpoint`` belongs to the run: the same
    run with the same checkpoint goes on where it stopped.
    """
    def sorted_batch(rows: DataFrame, number: int) -> None:
        changes = doc_sort_report(shipments, prepare(rows), day, forwarder, rules)
        # The same batch has the same documents at each attempt, so replacing is repeating.
        change_log(changes).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{RUN}={run}/{BATCH}={number}")

    query = (stream.writeStream.foreachBatch(sorted_batch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def read_sorted(spark: SparkSession, path: str, run: str) -> DataFrame:
    """The changes of a run, as far as it has come."""
    log = spark.read.option("basePath", path).parquet(path).where(F.col(RUN) == run).drop(RUN, BATCH)
    return rename(log, {heading: column for column, heading in HEADINGS.items()}).to(SCHEMAS["change_log"])
