"""Bounded samples of labelled rows, for training."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shipreport.llm.common import fold


def labelled_sample(labels: DataFrame, label: str, folds: int, held_out: int, size: int) -> DataFrame:
    """About ``size`` labelled ids (doc_id, label) outside the held-out fold.

    Rows are kept by a hash of the id, in proportion to how many there are, so the sample
    is the same on every run. Of repeated labels of an id the largest counts. The result
    has at most ``size`` rows but for chance (four standard deviations are left as room).
    """
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (fold("doc_id", folds) != held_out))
    rows = rows.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    share = share_of(rows.count(), size)
    return rows.where(in_share("doc_id", 17, share))


def in_share(doc_id: str, seed: int, share: float) -> Column:
    """Whether a hash of the id lies in a share of all its values, however small the share is.

    Whole millionths are told by one hash, and what is left of the last one by a second.
    """
    def hashed(*more: int) -> Column:
        return F.xxhash64(F.col(doc_id).cast("long"), F.lit(seed), *[F.lit(m) for m in more])

    whole = int(share * 1_000_000)
    millionth, rest = F.pmod(hashed(), F.lit(1_000_000)), share * 1_000_000 - whole
    limit = min(int(rest * 2.0 ** 64), 2 ** 64 - 1) - 2 ** 63
    return (millionth < whole) | ((millionth == whole) & (hashed(1) < F.lit(limit)))


def share_of(n: int, size: int) -> float:
    """The share of ``n`` rows that gives at most ``size`` of them, with room for chance."""
    return 1.0 if n <= size else max(size - 4 * size ** 0.5, 0) / n
