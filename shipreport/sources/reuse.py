"""Intermediates that several parts of a report share, and who lets go of them.

``owned`` is the owner: what reports keep inside its block is read by everything derived from
them, however far, and is released when the block ends. Without an owner a report holds what it
keeps itself (``holding``), and frames derived from it compute it again once the report is gone.
``written`` is an intermediate with a name and a place, which outlives lost executors.
"""

from __future__ import annotations

import contextlib
import contextvars
import weakref
from collections.abc import Iterator

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from shipreport.sources.folders import remove_folder, shared_folder

_OWNER: contextvars.ContextVar[list[DataFrame] | None] = contextvars.ContextVar("owner", default=None)


@contextlib.contextmanager
def owned() -> Iterator[list[DataFrame]]:
    """All that is kept inside the block is kept until its end. Blocks may be nested."""
    kept: list[DataFrame] = []
    token = _OWNER.set(kept)
    try:
        yield kept
    finally:
        _OWNER.reset(token)
        for df in kept:
            df.unpersist()


def shared(df: DataFrame) -> DataFrame:
    """``df``, computed now and once for all its uses.

    Computing it first is no extra work, and gives the plans of all its uses its real size. It
    is kept in executor memory and on disk, and lost blocks are recomputed from lineage.
    Inside ``owned`` the owner lets go of it; otherwise it goes when the returned frame does, and a
    report holds it by ``holding``.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    kept.count()
    owner = _OWNER.get()
    if owner is None:
        weakref.finalize(kept, _let_go, kept._jdf).atexit = False
    else:
        owner.append(kept)
    return kept


def holding(out: DataFrame, *kept: DataFrame) -> DataFrame:
    """``out``, which keeps ``kept`` alive."""
    out._held = kept
    return out


@contextlib.contextmanager
def written(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``df`` as a table in the shared folder, also as the temporary view ``name``, until the block ends.

    A lost executor costs nothing here: rows are read again, not computed again. A view of this
    name that was there before is replaced.
    """
    spark = df.sparkSession
    place = shared_folder(spark, name)
    try:
        df.write.parquet(place)
        out = spark.read.schema(df.schema).parquet(place)
        out.createOrReplaceTempView(name)
        yield out
    finally:
        spark.catalog.dropTempView(name)
        remove_folder(spark, place)


def _let_go(jdf) -> None:
    with contextlib.suppress(Exception):  # the session may be gone
        jdf.unpersist(False)
