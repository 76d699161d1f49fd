"""Parts that the shipment reports share."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shipreport.functions.text import fold
from shipreport.operators.stacking import stack_modes
from shipreport.plans.modes import Mode

SHIPMENT = ["mode", "source_id", "station"]
MASTER = ["mode", "master_id", "station"]


def with_join_keys(tables: Mapping[str, DataFrame], ignore_case: bool) -> dict[str, DataFrame]:
    """Codes that are only compared are folded; numbers that are printed get a key beside them."""

    def folded(df: DataFrame) -> DataFrame:
        out: dict[str, Column] = {}
        for name in ("station", "mode", "key"):
            if name in df.columns:
                out[name] = fold(F.col(name), ignore_case)
        for name, key in (("invoice_no", "invoice_key"), ("house_no", "house_key")):
            if name in df.columns:
                out[key] = fold(F.col(name), ignore_case)
        return df.withColumns(out) if out else df

    return {name: folded(df) for name, df in tables.items()}


def houses_of(tables: Mapping[str, DataFrame], modes: Sequence[Mode]) -> DataFrame:
    """House bills of several modes, one below the other."""
    stacked = stack_modes({m.code: tables[f"house_{m.code}"] for m in modes})
    return stacked.withColumnRenamed("id", "source_id")
