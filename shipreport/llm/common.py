"""What the operators share: tables, frames kept in the shared folder, Arrow helpers."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python 1,000 rows at a time, unless the session has chosen a number itself."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, "1000")


def kept(df: DataFrame) -> DataFrame:
    """``df``, computed once and written to the shared checkpoint folder.

    The folder is the one that the session names in spark.checkpoint.dir. Only where it
    names none, as in tests, a temporary folder of this machine is set.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return df.checkpoint(eager=True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(doc_id: str, n: int) -> Column:
    """crc32 of the id's decimal text, modulo ``n``; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % n


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    return batch.column(name).cast(pa.binary()).to_pylist()


def gathered(batches: Iterator[pa.RecordBatch], size: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of ``column`` each."""
    held, total = [], 0

    def joined():
        return pa.Table.from_batches(held).combine_chunks().to_batches()

    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            held.append(part)
            total += part.column(column).nbytes
            if total >= size:
                yield from joined()
                held, total = [], 0
    if held:
        yield from joined()


def groups(batches, keys):
    """Tables of rows with equal ``keys``, from rows sorted by them."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for v in values:
            change[1:] |= v[1:] != v[:-1]
        first = tuple(v[0] for v in values)
        if held and first != last:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if a and held:
                yield pa.Table.from_batches(held).combine_chunks()
                held = []
            held.append(batch.slice(a, b - a))
        last = tuple(v[-1] for v in values)
    if held:
        yield pa.Table.from_batches(held).combine_chunks()
