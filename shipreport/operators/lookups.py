"""One row per key: latest booking, milestones, any value of an invoice.

All are aggregates with map-side partials, so a hot key is reduced before the
shuffle. Ties are settled by the picked values themselves, which makes the result
independent of row order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str],
              greatest: Sequence[str] = ()) -> DataFrame:
    """The ``values`` of the row with the greatest ``order`` per key, NULL order last.

    Equal values of a key are first reduced to their greatest order, which a hash aggregate
    can do; only what is left meets in structs. A struct compares field by field with NULL
    lowest, so a key whose orders are all NULL still gives a row. ``greatest`` are further
    columns of which the greatest value is given.
    """
    reduced = df.groupBy(*keys, *values).agg(F.max(order).alias(order), *[F.max(c).alias(c) for c in greatest])
    top = F.max(F.struct(order, *values)).alias("_top")
    picked = [F.col(f"_top.{c}").alias(c) for c in (order, *values)]
    return reduced.groupBy(*keys).agg(top, *[F.max(c).alias(c) for c in greatest]).select(*keys, *picked, *greatest)


def top1(df: DataFrame, keys: Sequence[str], order: str, ties: Sequence[str]) -> DataFrame:
    """``latest_by`` as a window; Spark limits each group before the shuffle."""
    ranked = W.partitionBy(*keys).orderBy(
        F.desc_nulls_last(order), *[F.desc_nulls_last(t) for t in ties])
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def latest_milestones(milestones: DataFrame, wanted: Mapping[str, int],
                      key: str = "key") -> DataFrame:
    """Per shipment, the time of the newest row (by id) of each wanted milestone."""
    rows = milestones.where(F.col("milestone_id").isin(list(wanted.values())))
    return rows.groupBy(key).agg(*[
        F.max_by("time", F.when(F.col("milestone_id") == m, F.col("id"))).alias(name)
        for name, m in wanted.items()
    ])


def any_milestones(milestones: DataFrame, wanted: Mapping[str, int], product_line: int,
                   status: int, key: str = "key") -> DataFrame:
    """Per shipment, one time of each wanted milestone among rows of a line and status.

    Any row may be taken; the newest by id is, as in ``latest_milestones``.
    """
    rows = milestones.where((F.col("product_line") == product_line) & (F.col("status") == status))
    return latest_milestones(rows, wanted, key)


def any_of(df: DataFrame, keys: Sequence[str], column: str, name: str | None = None) -> DataFrame:
    """One value per key where any would do: the least. Repeats are left out by hash first."""
    # The count is used, so that Catalyst does not take the two aggregates for one.
    reduced = df.groupBy(*keys, column).agg(F.count(F.lit(1)).alias("_n")).where("_n > 0")
    return reduced.groupBy(*keys).agg(F.min(column).alias(name or column))


def first_of(*cols: Column) -> Column:
    return F.coalesce(*cols)
