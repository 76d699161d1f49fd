"""Stack per-mode tables and branches into one frame."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack_modes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Tables of several modes as one, with the mode in column ``mode``."""
    tagged = [df.withColumn("mode", F.lit(mode)) for mode, df in tables.items()]
    return reduce(DataFrame.unionByName, tagged)


def union_modes(branches: Mapping[str, DataFrame], distinct: bool) -> DataFrame:
    """Branches one below the other, with or without their duplicate rows.

    Branches differ by mode, so duplicates arise inside a branch only and one
    ``distinct`` over all of them is the same as one for each.
    """
    stacked = stack_modes(branches)
    return stacked.distinct() if distinct else stacked
