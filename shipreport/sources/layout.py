"""Tables laid out for the reports' joins and ranges: by station and month, in buckets of a join key.

A bucketed table is written once with its rows dealt by the join key, so that tables of equal
buckets are joined without a shuffle. Date ranges name the months they touch, so that only
those folders are read. Keys with more rows than a fair bucket are found by one count when the table
is written; their rows lie apart, without buckets, and are joined by ``fan_out``, which
spreads them. Every row is in one of the two parts.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shipreport.operators.filters import date_range
from shipreport.operators.joins import Probe, fan_out
from shipreport.sources.contracts import backticks

#: Partition columns; the values they come from stay in the rows as well.
STATION, MONTH = "part_station", "part_month"


def month_of(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(backticks(k)) for k in keys])


@dataclass(frozen=True)
class Laid:
    """A written table: its rows in buckets, and those of hot keys apart."""

    spark: SparkSession
    name: str
    keys: tuple[str, ...]
    buckets: int
    columns: tuple[str, ...]
    hot: tuple[int, ...] = field(default=())

    def bucketed(self) -> DataFrame:
        return self.spark.table(self.name)

    def apart(self) -> DataFrame:
        return self.spark.table(f"{self.name}_hot")

    def rows(self) -> DataFrame:
        """All rows, in the columns they were written with."""
        every = self.bucketed() if not self.hot else self.bucketed().unionByName(self.apart())
        return every.select(*map(backticks, self.columns))

    def between(self, column: str, start: dt.datetime, end: dt.datetime) -> DataFrame:
        """The rows with a date in an inclusive range, from the folders of its months only.

        ``column`` is the one that the months were taken from.
        """
        months = F.col(MONTH).between(f"{start:%Y-%m}", f"{end:%Y-%m}")
        parts = [self.bucketed(), *([self.apart()] if self.hot else [])]
        found = [part.where(months & date_range(column, start, end)).select(*map(backticks, self.columns)) for part in parts]
        return found[0] if len(found) == 1 else found[0].unionByName(found[1])

    def drop(self) -> None:
        """Forget the tables; their files stay where they are."""
        for name in (self.name, f"{self.name}_hot"):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def lay_out(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int, date: str | None = None,
            station: str | None = "station") -> Laid:
    """Write ``df`` as the table ``name`` below ``path`` and return it.

    Rows are dealt by ``keys`` before they are written, so that a bucket of a folder is one file.
    ``station`` and ``date`` name the columns that the folders are made from.
    """
    spark, keys = df.sparkSession, list(keys)
    folders = {}
    if station:
        folders[STATION] = F.col(station)
    if date:
        folders[MONTH] = month_of(F.col(date))
    hot = tuple(h for h, _ in Probe(df, keys).hot(keys))
    rows = df.withColumns(folders)

    def save(part: DataFrame, table: str, in_buckets: bool) -> None:
        writer = part.write.format("parquet").mode("overwrite").option("path", f"{path.rstrip('/')}/{table}")
        if folders:
            writer = writer.partitionBy(*folders)
        if in_buckets:
            writer = writer.bucketBy(buckets, keys[0], *keys[1:]).sortBy(keys[0], *keys[1:])
        writer.saveAsTable(table)

    cold = rows.where(~_key_hash(keys).isin(*hot)) if hot else rows
    save(cold.repartition(buckets, *keys), name, True)
    if hot:
        save(rows.where(_key_hash(keys).isin(*hot)), f"{name}_hot", False)
    return Laid(spark, name, tuple(keys), buckets, tuple(df.columns), hot)


def co_located(left: Laid, right: Laid, how: str = "left") -> DataFrame:
    """Left or inner join of two tables in equal buckets of the same keys, without a shuffle.

    Only keys that are hot on either side go through ``fan_out``.
    """
    if left.keys != right.keys or left.buckets != right.buckets:
        raise ValueError(f"{left.name} and {right.name} have other keys or buckets")
    keys, hot = list(left.keys), sorted({*left.hot, *right.hot})
    columns = [c for c in right.columns if c not in keys]
    mine = [F.col(backticks(c)) for c in (*left.columns,)]
    theirs = [F.col(backticks(c)) for c in (*keys, *columns)]
    a, b = left.bucketed().select(*mine), right.bucketed().select(*theirs)
    if not hot:
        return a.join(b, keys, how)
    is_hot = _key_hash(keys).isin(*hot)
    cold = a.where(~is_hot).join(b.where(~is_hot), keys, how)
    apart = fan_out(left.rows().where(is_hot), right.rows().select(*theirs).where(is_hot), keys, how)
    return cold.unionByName(apart)
