"""Row filters of the invoice and shipment reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shipreport.functions.text import code_eq, code_in, code_ne, is_blank, not_blank, right_chars
from shipreport.operators.joins import in_list


def date_range(column: str, start: dt.datetime, end: dt.datetime) -> Column:
    """Inclusive at both ends; an end at midnight leaves out the rest of that day."""
    col = F.col(column)
    return col.between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"))


def not_void(column: str, word: str = "VOID", ignore_case: bool = True) -> Column:
    """Status differs from ``word``; a NULL status is dropped as well."""
    return code_ne(F.col(column), word, ignore_case)


def not_credit_note(column: str, mark: str = "C", ignore_case: bool = True) -> Column:
    """The invoice number does not end in the credit-note mark."""
    return code_ne(right_chars(F.col(column), 1), mark, ignore_case)


def billable(id_type: str = "H", mark: str = "C", ignore_case: bool = True) -> Column:
    """Numbered invoices of a house bill that are neither credit notes nor re-issues."""
    return (
        code_eq(F.col("id_type"), id_type, ignore_case)
        & not_blank(F.col("invoice_no"))
        & not_credit_note("invoice_no", mark, ignore_case)
        & is_blank(F.col("ref_invoice_no"))
    )


def eligible_invoices(headers: DataFrame, product_lines: Sequence[str], modes: Sequence[str],
                      customers: DataFrame | Sequence[int], start: dt.datetime, end: dt.datetime,
                      id_type: str = "H", mark: str = "C", ignore_case: bool = True) -> DataFrame:
    """The invoice headers a weight report starts from."""
    rows = headers.where(
        date_range("invoice_date", start, end)
        & code_in(F.col("product_line"), product_lines, ignore_case)
        & code_in(F.col("mode"), modes, ignore_case)
        & billable(id_type, mark, ignore_case)
    )
    return in_list(rows, "customer_id", customers)


def etd_window(df: DataFrame, column: str, first: dt.date, last: dt.date) -> DataFrame:
    """Departures from the first to the last day, both whole days."""
    after = last + dt.timedelta(days=1)
    col = F.col(column)
    return df.where(
        (col >= F.lit(dt.datetime.combine(first, dt.time())).cast("timestamp_ntz"))
        & (col < F.lit(dt.datetime.combine(after, dt.time())).cast("timestamp_ntz"))
    )
