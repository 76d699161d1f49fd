"""Station-routed and shared table scans.

A station code is looked up in a map of locations. A location is a catalog schema
(``station_sg``, ``lake.station_sg``), a directory of table folders (``/lake/sg``) or
a path pattern (``/lake/sg/{table}.parquet``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from shipreport.sources.contracts import backticks
from shipreport.sources.schemas import MASTER_TABLES, SCHEMAS, STATION_TABLES

Tables = Mapping[str, DataFrame]


def read_table(spark: SparkSession, location: str, name: str, file_format: str = "parquet") -> DataFrame:
    if "/" not in location:
        return spark.table(f"{location}.{name}")
    path = location if "{table}" in location else location.rstrip("/") + "/{table}"
    return spark.read.format(file_format).load(path.replace("{table}", name))


def canonical(df: DataFrame, schema: str, columns: Mapping[str, str]) -> DataFrame:
    """Select and cast physical columns to a canonical schema."""
    have = {c.lower(): c for c in df.columns}

    absent = [p for p in columns.values() if p.lower() not in have]
    if absent:
        raise ValueError(f"{schema}: no column {', '.join(sorted(set(absent)))}")

    def source(name: str) -> str:
        return backticks(have[columns[name].lower()]) if name in columns else "NULL"

    return df.selectExpr(*[
        f"CAST({source(f.name)} AS {f.dataType.simpleString()}) AS {f.name}"
        for f in SCHEMAS[schema].fields])


@dataclass(frozen=True)
class Stations:
    """Locations of the station databases and of the shared master database."""

    locations: Mapping[str, str]
    master: str
    file_format: str = "parquet"

    def locate(self, station: str) -> str:
        code = station.strip().upper()
        for name, location in self.locations.items():
            if name.upper() == code:
                return location
        raise KeyError(f"unknown station: {station}")

    def table(self, spark: SparkSession, station: str, name: str) -> DataFrame:
        return read_table(spark, self.locate(station), name, self.file_format)

    def shared(self, spark: SparkSession, name: str) -> DataFrame:
        return read_table(spark, self.master, name, self.file_format)

    def tables(self, spark: SparkSession, station: str, names: Iterable[str] | None = None) -> dict[str, DataFrame]:
        """The canonical tables ``names`` of this station, or all; others are not opened."""
        wanted = set(names) if names is not None else {*STATION_TABLES, *MASTER_TABLES}
        own = {key: canonical(self.table(spark, station, physical), schema, columns)
               for key, (schema, physical, columns) in STATION_TABLES.items() if key in wanted}
        shared = {key: canonical(self.shared(spark, physical), schema, columns)
                  for key, (schema, physical, columns) in MASTER_TABLES.items() if key in wanted}
        if missing := wanted - {*own, *shared}:
            raise KeyError(f"unknown tables: {', '.join(sorted(missing))}")
        return own | shared


def run_sql(spark: SparkSession, text: str, params: Mapping[str, Any], **frames: DataFrame) -> DataFrame:
    """SQL with typed named parameters (``:start``) over frames named in braces."""
    return spark.sql(text, args=dict(params), **frames)
