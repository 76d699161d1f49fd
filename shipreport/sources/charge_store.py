"""Charge sums per invoice, kept by month and brought up to date month by month.

Sums lie in one folder a month. When lines arrive, the months of their invoices are found, only
those are summed again, from all their lines, and only their folders are replaced (Spark's
dynamic partition overwrite). A refresh that fails leaves all folders as they were, and one that
is run twice gives the same sums.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipreport.operators.charges import charge_pivot
from shipreport.operators.joins import attach, paired
from shipreport.sources.layout import month_of

MONTH, MARK = "month", "is_mark"
#: The folder of invoices without a date.
UNDATED = "undated"


@dataclass(frozen=True)
class ChargeStore:
    """``columns`` maps an output name to (measure, charge codes), as ``charge_pivot`` takes it."""

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    columns: Mapping[str, tuple[str, Sequence[int]]]

    def months(self, headers: DataFrame, date: str = "invoice_date") -> DataFrame:
        """The month each invoice is kept in: that of its first header. One row per key."""
        return headers.groupBy(*self.keys).agg(F.coalesce(month_of(F.min(date)), F.lit(UNDATED)).alias(MONTH))

    def touched(self, headers: DataFrame, arrived: DataFrame, date: str = "invoice_date") -> list[str]:
        """The months whose sums change by the lines that arrived: a list as long as the calendar."""
        of_key = self.months(headers, date)
        found = paired(arrived.select(*self.keys).distinct(), of_key, self.keys)
        return sorted(r[0] for r in found.select(MONTH).distinct().collect())

    def refresh(self, headers: DataFrame, lines: DataFrame, months: Iterable[str] | None = None, date: str = "invoice_date") -> None:
        """Sum ``lines`` again for the invoices of ``months``, or of all months, and replace their folders.

        Lines without a header are left out. A month that has lost its last line is emptied: each
        month replaced has a row of its own that says so.
        """
        of_key = self.months(headers, date)
        if months is not None:
            months = sorted(set(months))
            if not months:
                return
            of_key = of_key.where(F.col(MONTH).isin(months))
            marks = self.spark.createDataFrame([(m,) for m in months], f"{MONTH} string")
        else:
            marks = of_key.select(MONTH).distinct()
        # Sums first, months then: lines are reduced before they meet a second table.
        wanted = attach(lines, of_key.select(*self.keys), self.keys, "left_semi") if months is not None else lines
        sums = paired(charge_pivot(wanted, self.keys, self.columns), of_key, self.keys)
        rows = sums.withColumn(MARK, F.lit(False)).unionByName(marks.withColumn(MARK, F.lit(True)), allowMissingColumns=True)
        # One task a month and no more files than that; a month's sums are a small part of its lines.
        rows.repartition(MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(self.path)

    def read(self, months: Iterable[str] | None = None) -> DataFrame:
        """The sums, by key; of some months only where these are named."""
        rows = self.spark.read.option("basePath", self.path).schema(self._schema()).parquet(self.path)
        if months is not None:
            rows = rows.where(F.col(MONTH).isin(list(months)))
        return rows.where(~F.col(MARK)).select(*self.keys, *[F.col(f"`{c}`") for c in self.columns])

    def _schema(self):
        # Months look like dates to Spark's own guess at partition columns.
        found = self.spark.read.parquet(self.path).drop(MONTH).schema
        return found.add(MONTH, "string")
