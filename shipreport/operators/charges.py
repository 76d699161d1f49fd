"""Charge sums per invoice, all columns in one pass over the invoice lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipreport.operators.joins import fan_out

CODE = "charge_id"


def charge_pivot(lines: DataFrame, keys: Sequence[str],
                 columns: Mapping[str, tuple[str, Sequence[int]]],
                 least: Mapping[str, str] | None = None) -> DataFrame:
    """Sum a measure over charge codes into one column each.

    ``columns`` maps an output name to (measure, codes). A key without a line of
    those codes gets NULL, not 0. ``least`` maps further output names to columns of which the least value
    of all lines is given; without it only lines of the codes are read. Sums are first
    taken for each of those values, so that all lines are reduced by hash.
    """
    if not least:
        codes = sorted({c for _, cs in columns.values() for c in cs})
        lines = lines.where(F.col(CODE).isin(codes))
    sums = [F.sum(F.when(F.col(CODE).isin(list(cs)), F.col(measure))).alias(name)
            for name, (measure, cs) in columns.items()]
    if not least:
        return lines.groupBy(*keys).agg(*sums)
    some = {name: F.col(column) for name, column in least.items()}
    reduced = lines.withColumns(some).groupBy(*keys, *some).agg(*sums)
    kinds = {c: reduced.schema[c].dataType for c in columns}
    return reduced.groupBy(*keys).agg(
        *[F.sum(F.col(f"`{c}`")).cast(kinds[c]).alias(c) for c in columns], *[F.min(F.col(f"`{n}`")).alias(n) for n in some])


def invoice_lines(headers: DataFrame, lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Headers with their lines, one row per pair; headers without lines are kept."""
    return fan_out(headers, lines, keys)


def cached_charges(headers: DataFrame, lines: DataFrame, keys: Sequence[str],
                   columns: Mapping[str, tuple[str, Sequence[int]]],
                   least: Mapping[str, str] | None = None) -> DataFrame:
    """``charge_pivot`` as it comes out over the rows of ``invoice_lines``.

    There a line is repeated for every header of its key, so each sum is the line sum
    times the number of headers. Both sides are aggregated first; the pairs are never
    built.
    """
    copies = headers.groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
    # Both sides hold one row per key.
    sums = charge_pivot(lines, keys, columns, least).join(copies, list(keys))
    repeated = [(F.col(f"`{n}`") * F.col("_copies").cast("decimal(10,0)")).alias(n) for n in columns]
    return sums.select(*keys, *repeated, *[F.col(f"`{n}`") for n in least or {}])
