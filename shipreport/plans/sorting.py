"""Document sorting report: the type changes of last week's shipments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from shipreport.functions.dates import last_week_of
from shipreport.operators.documents import (
    CONTENT_RULES, Rules, cascade, change_counts, for_forwarder, type_changes)
from shipreport.operators.filters import etd_window
from shipreport.operators.joins import attach


def sorted_documents(shipments: DataFrame, docs: DataFrame, day: dt.date, forwarder: str,
                     rules: Rules = CONTENT_RULES) -> tuple[DataFrame, DataFrame]:
    """Last week's shipments, and their documents with stored and new type."""
    first, last = last_week_of(day)
    opened = etd_window(shipments, "etd", first, last).select("house_no").distinct()
    filled = for_forwarder(rules, forwarder)
    # The week always comes first: rules read the texts of its documents only.
    return opened, cascade(attach(docs, opened, ["house_no"], "left_semi"), filled, f"{forwarder} Invoice")


def doc_sort_report(shipments: DataFrame, docs: DataFrame, day: dt.date, forwarder: str,
                    rules: Rules = CONTENT_RULES) -> DataFrame:
    """The change rows of a run on ``day``."""
    _, typed = sorted_documents(shipments, docs, day, forwarder, rules)
    return type_changes(typed)


def doc_sort_counts(shipments: DataFrame, docs: DataFrame, day: dt.date, forwarder: str,
                    rules: Rules = CONTENT_RULES, total: str | None = None) -> DataFrame:
    """Documents and changes per shipment of a run on ``day``, and of all under the name ``total``."""
    opened, typed = sorted_documents(shipments, docs, day, forwarder, rules)
    return change_counts(opened, typed, total=total)
