"""Result contracts: names, order and types of report columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shipreport.functions.dates import fmt_default


def backticks(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def quoted(name: str) -> Column:
    """A column whose name may hold blanks, dots or brackets."""
    return F.col(backticks(name))


def literal(value: str | None) -> str:
    """A text literal of Spark SQL."""
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def with_constants(df: DataFrame, values: Mapping[str, str | None]) -> DataFrame:
    """Add constant text columns, in one projection."""
    return df.selectExpr("*", *[f"{literal(v)} AS {backticks(n)}" for n, v in values.items()])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Select the columns of ``names`` under their report names."""
    return df.select(*[quoted(c).alias(n) for c, n in names.items()])


def to_contract(df: DataFrame, fields: Sequence[tuple[str, str]]) -> DataFrame:
    """Cast to the declared result, (name, type) in order."""
    return df.selectExpr(*[f"CAST({backticks(n)} AS {t}) AS {backticks(n)}" for n, t in fields])


def to_strings(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The declared result as text, datetimes in the server's default form."""
    dates = {f.name for f in df.schema.fields
             if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))}
    shown = df.withColumns({n: fmt_default(quoted(n).cast("timestamp_ntz")) for n in names if n in dates})
    return to_contract(shown, [(n, "string") for n in names])
